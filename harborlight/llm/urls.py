"""URL filter with redirect equivalence.

Addresses that redirect to each other, or declare the same canonical link, are one
resource: they form a connected component, and a block decision on one member holds
for its aliases.  An explicit allow rule on any member wins over blocks reached
through aliases, and a member's own rule wins over everything.

Edges come from ``<link rel="canonical">`` and ``<meta http-equiv="refresh">`` of a
page, resolved against its ``<base>`` or else its own address, and from its normalized address (scheme, fragment, ``www.``/``m.``, trailing
slash and tracking parameters removed).  Components are found with alternating
large-star and small-star steps over 64-bit node keys, each step written to the shared
scratch folder; only counts reach the driver.  A star centre may hold any share of
the edges: neighbour minima are plain aggregations, which combine before the shuffle.

Defined cases: a null address, or one without ``://``, has an empty host and path,
matches no rule, has no aliases and is allowed; repeated rows are judged alike; ties
between rules of one length cannot occur, since equally long rules that fit one address
are the same rule; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.llm.common import UPPER
from harborlight.llm.components import components

TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid|source|sessionid)="
LINK_TAG = r"(?is)(<link\b[^>]*>)"
META_TAG = r"(?is)(<meta\b[^>]*>)"
IS_CANONICAL = r"(?is)\brel\s*=\s*[\"']?canonical\b"
IS_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*[\"']?\s*([^\"'\s>]+)"
BASE_TAG = r"(?is)(<base\b[^>]*\bhref\s*=[^>]*>)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rest(url: Column) -> Column:
    """What follows the first ``://``, or null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    found = F.lit(None)
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.text).alias("rule"))
        found = F.when(fits, chosen).otherwise(found)
    return found


def normalized(url: Column) -> Column:
    """Address without scheme, fragment, mobile or www label, tracking and last slash."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    suffix = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
    return F.concat(host, path, F.coalesce(suffix, F.lit("")))


def declared_links(html: Column) -> Column:
    """Targets of canonical links and redirects, as an array."""
    def targets(tag: str, kind: str, attribute: str) -> Column:
        tags = F.filter(F.regexp_extract_all(html, F.lit(tag), F.lit(1)), lambda t: t.rlike(kind))
        return F.transform(tags, lambda t: F.regexp_extract(t, attribute, 1))

    links = F.concat(
        targets(LINK_TAG, IS_CANONICAL, HREF), targets(META_TAG, IS_REFRESH, REFRESH_URL)
    )
    return F.when(
        html.rlike("(?i)canonical|refresh"), F.filter(links, lambda x: x != "")
    ).otherwise(F.array().cast("array<string>"))


def _without_dots(path: Column) -> Column:
    """A path with ``.`` and ``..`` segments applied, never above its root."""

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolved(base: Column, target: Column) -> Column:
    """Address that ``target`` means on the page ``base``; null if it names no host."""
    scheme = F.substring_index(base, "://", 1)
    site = F.concat(scheme, F.lit("://"), F.regexp_extract(rest(base), r"^[^/?#]*", 0))
    path = F.regexp_extract(target, r"^[^?#]*", 0)
    tail = F.substr(target, F.length(path) + F.lit(1))
    folder = F.regexp_extract(path_of(base), r"^.*/", 0)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    query = F.regexp_extract(rest(base), r"^[^?#]*(\?[^#]*)?", 1)
    same = F.concat(site, path_of(base), F.when(tail.startswith("?"), F.lit("")).otherwise(query), tail)
    return (
        F.when(target.rlike(SCHEME + "//"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.rlike(SCHEME), F.lit(None).cast("string"))
        .when(path == "", same)
        .otherwise(F.concat(site, _without_dots(full), tail))
    )


def base_address(url: Column, html: Column) -> Column:
    """The address that links of a page are relative to."""
    stated = F.regexp_extract(F.regexp_extract(html, BASE_TAG, 1), HREF, 1)
    return F.when(stated != "", F.coalesce(resolved(url, stated), url)).otherwise(url)


def alias_edges(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Distinct (a, b) pairs of node keys; nodes are normalized addresses."""
    url = F.col(url_column)
    html = F.col(html_column)
    source = pages.filter(rest(url).isNotNull()).select(
        normalized(url).alias("at"),
        F.when(html.rlike("(?i)canonical|refresh"), base_address(url, html)).alias("base"),
        F.coalesce(declared_links(html), F.array().cast("array<string>")).alias("to"),
    )
    links = source.select("at", "base", F.explode("to").alias("to"))
    links = links.select("at", resolved(F.col("base"), F.col("to")).alias("to")).filter("to is not null")
    return (
        links.select(node_key(F.col("at")).alias("a"), node_key(normalized(F.col("to"))).alias("b"))
        .filter("a <> b")
        .distinct()
    )


def node_key(address: Column) -> Column:
    return F.xxhash64(address)


def judge(
    pages: DataFrame,
    rules: tuple[UrlRule, ...],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """page_id, host, path, the page's own ``rule``, its ``alias_rule`` state and ``verdict``."""
    url = F.col(url_column)
    base = pages.select(
        F.col(id_column).alias("page_id"),
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.when(rest(url).isNotNull(), node_key(normalized(url))).alias("node"),
    ).select("*", best_rule(F.col("host"), F.col("path"), rules).alias("own"))
    roots = components(alias_edges(pages, url_column, html_column))
    placed = base.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    decided = placed.filter("own is not null and root is not null").groupBy("root").agg(
        F.max((F.col("own.verdict") == "allow").cast("int")).alias("allows"),
        F.max((F.col("own.verdict") == "block").cast("int")).alias("blocks"),
    )
    joined = placed.join(decided, "root", "left")
    through_aliases = F.when(
        (F.col("blocks") == 1) & (F.col("allows") == 0), F.lit("block")
    ).otherwise(F.lit("allow"))
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), through_aliases).alias("verdict"),
        F.when(F.col("own").isNull() & (F.col("blocks") == 1), F.lit(True))
        .otherwise(F.lit(False))
        .alias("decided_by_alias"),
    )
