"""Personal data: exact base patterns, extended by bootstrapped contextual extraction.

Base spans are the leftmost, non-overlapping matches of four patterns (e-mail and IP
addresses, card and phone numbers), checked afterwards and not retried.  They seed the
bootstrapping: they, and runs of neighbouring tokens that hold a digit or ``@`` and touch
no base span, are instances; the words around them are patterns, and both form a graph.
A token among those words counts as a number, whatever it is, and so do the ends of a
text as words; text stuck to a base span is no word.  Long unbroken runs of letters and digits (keys,
digests) are seeds of a fifth kind, ``secret``, but only assumed ones: by themselves they are
not reported.  A pattern is trusted as far as its instances are known, an instance as far
as its patterns are trusted.  Both only grow, and when a round adds neither a pattern nor an
instance, what trusted patterns with enough different known instances surround is reported
too, the assumed seeds among it.

Everything is column expressions, aggregations and joins.  A match's place follows from
the lengths of the stretches between matches, summed over the rows of a document; no
array is built up step by step, so a text may hold any number of matches.  Patterns and
instances that occur very often are only aggregated, and the scores they are joined
with hold one row per key.

The patterns are written so that a long run of characters is never tried again from its
middle: a match can only begin where a run begins or the last match ended.

Defined cases: null and empty texts hold nothing; repeated rows have equal results; rows
without id are treated like others; an empty table gives an empty result; extra columns
are ignored, and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.llm.common import checked, let, stored

KINDS = ("email", "ip", "card", "phone")
#: kinds of found spans: the base ones, and secrets, which only contexts can tell
ALL_KINDS = (*KINDS, "secret")
#: what a secret looks like, lower-cased and without marks around it
SECRET_FORM = r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]{32,}$"
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20\-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_BLANK = r"\x20\x09-\x0D"
TOKEN = rf"(?<![^{_BLANK}])[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
_EDGES = r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$"
AROUND = ("before2", "before", "after", "joined")
#: what stands for a token, and for the ends of a text, among lower-case context words
NUMBER, BEGIN, END = "N", "BEGIN", "END"
#: a card has no more digits than this, so no kind is written in more tokens
MOST_TOKENS = 19

#: rounds end when nothing is added; each adds a pattern or an instance, and some few suffice
ROUNDS = 50
#: a trusted pattern surrounds so many different known instances of one kind ...
LEAST_INSTANCES = 4
#: ... and they make up this share of all its instances
LEAST_SHARE = 0.7


# --- base patterns -----------------------------------------------------------


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-sum of card numbers."""

    def value(place: Column) -> Column:
        digit = F.substring(F.reverse(digits), place, F.lit(1)).cast("int")
        doubled = digit * 2
        odd = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return F.when(place % 2 == 0, odd).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def is_valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        small = F.forall(
            parts, lambda p: (F.length(p) <= 3) & (F.concat(F.lit("0"), p).cast("long") <= 255)
        )
        return small
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _around(gaps: Column, i: Column) -> list[Column]:
    """Two words before token ``i``, the word after it, and whether only blanks part it from the last.

    Gaps hold the plain words between tokens, so where a gap has too few, a token follows.
    """

    def word(gap: Column, k: int) -> Column:
        found = F.regexp_extract(F.reverse(gap), rf"^[{_BLANK}]*+([^{_BLANK}]++)(?:[{_BLANK}]++([^{_BLANK}]++))?", k)
        return F.lower(F.reverse(F.nullif(found, F.lit(""))))

    def other(place: Column) -> Column:
        return F.when(place > 0, F.lit(NUMBER)).otherwise(F.lit(BEGIN))

    one = F.lit(1)
    gap, earlier = F.get(gaps, i), F.get(gaps, i - one)
    near = F.coalesce(word(gap, 1), other(i))
    far = (
        F.when(word(gap, 1).isNotNull(), F.coalesce(word(gap, 2), other(i)))
        .when(i > 0, F.coalesce(word(earlier, 1), other(i - one)))
        .otherwise(F.lit(BEGIN))
    )
    next_word = F.regexp_extract(F.get(gaps, i + one), rf"^[{_BLANK}]*+([^{_BLANK}]++)", 1)
    last = F.when(i + F.lit(2) >= F.size(gaps), F.lit(END)).otherwise(F.lit(NUMBER))
    after = F.coalesce(F.lower(F.nullif(next_word, F.lit(""))), last)
    return [far, near, after, (i > 0) & word(gap, 1).isNull()]


def _placed(text: Column, pattern: str, kind: str) -> Column:
    """Matches with the length of the stretch before them, tokens with the words around them."""

    def zipped(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))

        def one(m: Column, i: Column) -> Column:
            none = [F.lit(None).cast(t) for t in ("string", "string", "string", "boolean")]
            around = _around(gaps, i) if kind == "token" else none
            return F.struct(
                F.lit(kind).alias("kind"),
                i.alias("place"),
                F.length(F.get(gaps, i)).alias("gap"),
                m.alias("match"),
                *(c.alias(name) for c, name in zip(around, AROUND, strict=True)),
            )

        return F.transform(found, one)

    return let(F.split(text, pattern, -1), zipped)


def matches(texts: DataFrame) -> DataFrame:
    """(doc, hash, kind, place, start, stop, match, before2, before, after, joined) of all patterns and tokens."""
    parts = []
    for kind, pattern in {**PATTERNS, "token": TOKEN}.items():
        found = _placed(F.col("text"), pattern, kind)
        needed = F.col("text").contains(_NEEDS[kind]) if kind in _NEEDS else F.col("text").rlike("[0-9@]")
        parts.append(F.when(needed, found))
    rows = texts.select(
        "doc", "hash", F.explode(F.flatten(F.filter(F.array(*parts), lambda p: ~p.isNull()))).alias("m")
    ).select("doc", "hash", "m.*")
    once = rows.groupBy("doc", "hash", "kind", "place").agg(
        *(F.first(c).alias(c) for c in ("gap", "match", *AROUND))
    )
    length = F.length("match")
    so_far = Window.partitionBy("doc", "hash", "kind").orderBy("place")
    stop = F.sum(F.col("gap") + length).over(so_far)
    return once.withColumn("stop", stop).select(
        "doc", "hash", "kind", "place", (F.col("stop") - length).alias("start"), "stop", "match", *AROUND
    )


def base_spans(found: DataFrame) -> DataFrame:
    """(doc, hash, kind, start, stop) of the matches that pass their kind's check."""
    valid = F.lit(False)
    for kind in KINDS:
        valid = F.when(F.col("kind") == kind, is_valid(kind, F.col("match"))).otherwise(valid)
    return found.filter(valid).select("doc", "hash", "kind", "start", "stop", "match")


# --- bootstrapping -----------------------------------------------------------


def _patterns(before2: str, before: str, after: str) -> list[Column]:
    """The words before an instance, and the words on both sides of it."""
    return [F.concat_ws(" ", before2, before, F.lit("_")), F.concat_ws(" ", before, F.lit("_"), after)]


def _value(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, f"[{_BLANK}]+", " "))


def seeds(found: DataFrame, base: DataFrame) -> DataFrame:
    """(instance, kind, patterns) of base spans, with the words around the tokens they stand in."""
    tokens = found.filter("kind = 'token'")
    spot = F.struct("start", *AROUND)
    none = F.lit(None).cast(tokens.select(spot.alias("t")).schema["t"].dataType)
    ends = base.select("doc", "hash", "kind", "match", "start", F.explode(F.array("start", F.col("stop") - 1)).alias("at"))
    marks = tokens.select(
        "doc", "hash", F.lit(None).cast("string").alias("kind"), "match", "start", F.col("start").alias("at"), spot.alias("t")
    ).unionByName(ends.withColumn("t", none))
    so_far = Window.partitionBy("doc", "hash").orderBy("at", F.col("kind").isNotNull())
    held = F.last("t", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    whole = (
        marks.withColumn("t", held)
        .filter("kind is not null")
        .groupBy("doc", "hash", "kind", "start")
        .agg(F.first("match").alias("match"), F.min("t").alias("first"), F.max("t").alias("last"))
    )
    around = _patterns("first.before2", "first.before", "last.after")
    return whole.select(_value(F.col("match")).alias("instance"), "kind", F.array(*around).alias("patterns"))


def candidates(found: DataFrame, base: DataFrame) -> DataFrame:
    """(doc, hash, start, stop, instance, patterns) of runs of tokens that no base span touches.

    The words before a run do not tell where it ends, so they are a pattern of the longest only.
    """
    lead = F.length(F.regexp_extract("match", rf"^[^\p{{L}}\p{{N}}+]*", 0))
    value = F.regexp_replace("match", _EDGES, "")
    tokens = found.filter("kind = 'token'").withColumn("reach", F.lit(None).cast("long"))
    spans = base.select("doc", "hash", "start", F.col("stop").cast("long").alias("reach"))
    closing = Window.partitionBy("doc", "hash").orderBy(F.when(F.col("kind").isNull(), F.col("start") + 1).otherwise(F.col("stop")), "kind")
    covered = F.max("reach").over(closing.rowsBetween(Window.unboundedPreceding, 0))
    free = (
        tokens.unionByName(spans, allowMissingColumns=True)
        .withColumn("reach", covered)
        .filter("kind = 'token' and (reach is null or reach <= start)")
        .withColumn("lead", lead)
        .withColumn("inner", F.length(value))
        .filter("inner > 0")
    )
    order = Window.partitionBy("doc", "hash").orderBy("place")
    apart = ~F.coalesce(F.col("joined") & (F.lag("place").over(order) == F.col("place") - 1), F.lit(False))
    runs = free.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(order))
    ahead = Window.partitionBy("doc", "hash", "run").orderBy("place").rowsBetween(0, MOST_TOKENS - 1)
    end = F.struct("match", "after", (F.col("start") + F.col("lead") + F.col("inner")).alias("stop"))
    taken = runs.select(
        "doc", "hash", (F.col("start") + F.col("lead")).alias("start"), "before2", "before", F.collect_list(end).over(ahead).alias("ends")
    ).select("*", F.posexplode("ends").alias("k", "end"))
    text = F.array_join(F.transform(F.slice("ends", F.lit(1), F.col("k") + 1), lambda e: e["match"]), " ")
    left, both = _patterns("before2", "before", "end.after")
    longest = F.col("k") + 1 == F.size("ends")
    return taken.select(
        "doc",
        "hash",
        "start",
        F.col("end.stop").alias("stop"),
        F.lower(F.regexp_replace(text, _EDGES, "")).alias("instance"),
        F.when(longest, F.array(left, both)).otherwise(F.array(both)).alias("patterns"),
    )


def trusted_patterns(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, trust) of patterns that surround enough different known instances."""
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scored = (
        edges.join(known, "instance")
        .groupBy("pattern", "kind")
        .agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("n_known"))
        .filter(F.col("n_known") >= LEAST_INSTANCES)
    )
    trust = F.col("mass") / F.col("n")
    return (
        scored.join(totals, "pattern")
        .filter(trust >= LEAST_SHARE)
        .select("pattern", "kind", trust.alias("trust"))
    )


def bootstrap(runs: DataFrame, spans: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(instance, kind, score) of instances outside the base spans that trusted patterns support."""
    around = runs.select("instance", "patterns").union(spans.select("instance", "patterns"))
    edges = stored(around.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    seen = spans.select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    assumed = runs.filter(F.col("instance").rlike(SECRET_FORM)).select(
        "instance", F.lit("secret").alias("kind"), F.lit(1.0).alias("score")
    )
    assumed = assumed.distinct().join(seen.select("instance"), "instance", "left_anti")
    first, prior = stored(seen, "pii-first"), stored(assumed, "pii-assumed")
    known, found, size = first.unionByName(prior), None, (0, 0)
    for _ in range(rounds):
        trusted = stored(trusted_patterns(edges, known), "pii-trusted")
        found = stored(supported(edges, trusted).join(first.select("instance"), "instance", "left_anti"), "pii-known")
        before, size = size, (trusted.count(), found.count())
        if size == before or not any(size):
            break
        # what was assumed stays so; an instance counts by the better of both scores
        best = F.max(F.struct("score", "kind")).alias("best")
        scored = prior.unionByName(found).groupBy("instance").agg(best)
        known = first.unionByName(scored.select("instance", "best.kind", "best.score"))
    return found


def supported(edges: DataFrame, trusted: DataFrame) -> DataFrame:
    """(instance, kind, score): of all kinds the one that trusted patterns support most."""
    doubt = F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-6))))
    scored = edges.join(trusted, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
    best = scored.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("best"))
    return best.select("instance", "best.kind", "best.score")


def _islands(spans: DataFrame) -> DataFrame:
    """Overlapping spans of a document as one, of the kind that begins first."""
    order = Window.partitionBy("doc", "hash").orderBy("start", "stop", "kind")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1))
    return (
        spans.withColumn("apart", apart)
        .withColumn("part", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc", "hash", "part")
        .agg(
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.min_by("kind", F.struct("start", "stop", "kind")).alias("kind"),
        )
        .drop("part")
    )


def all_spans(texts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc, hash, kind, start, stop, is_base); found spans overlap neither base spans nor each other."""
    found = stored(matches(texts), "pii-matches")
    base = base_spans(found)
    runs = stored(candidates(found, base), "pii-runs")
    unseen = bootstrap(runs, stored(seeds(found, base), "pii-seeds"), rounds).select("instance", "kind")
    placed = _islands(runs.join(unseen, "instance").select("doc", "hash", "kind", "start", "stop"))
    marked = base.drop("match").withColumn("is_base", F.lit(True))
    return stored(marked.unionByName(placed.withColumn("is_base", F.lit(False))), "pii-spans")


# --- results -----------------------------------------------------------------


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("doc_id"),
        _doc(id_column).alias("doc"),
        F.xxhash64(F.col(text_column)).alias("hash"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def _doc(id_column: str) -> Column:
    return F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63)))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(spans)
    return F.array_join(
        F.transform(
            ordered,
            lambda s: F.concat_ws(
                ":", F.get(F.array(*map(F.lit, ALL_KINDS)), s["rank"]), s["start"].cast("string"), s["stop"].cast("string")
            ),
        ),
        ",",
    )


def personal_data(
    docs: DataFrame, rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: counts of base spans, ``base`` and ``spans`` as text, n_found."""
    keyed = _keyed(docs, id_column, text_column)
    spans = all_spans(keyed.select("doc", "hash", "text"), rounds)
    rank = F.array_position(F.array(*map(F.lit, ALL_KINDS)), F.col("kind")) - 1
    span = F.struct(rank.cast("int").alias("rank"), "start", "stop")
    counts = [
        F.count(F.when(F.col("is_base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS
    ]
    per_doc = spans.groupBy("doc", "hash").agg(
        *counts,
        F.count(F.when(~F.col("is_base"), 1)).alias("n_found"),
        _joined(F.collect_list(F.when(F.col("is_base"), span))).alias("base"),
        _joined(F.collect_list(span)).alias("spans"),
    )
    names = [f"n_{k}" for k in KINDS] + ["n_found"]
    return keyed.select("doc_id", "doc", "hash").join(per_doc, ["doc", "hash"], "left").select(
        "doc_id",
        *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names),
        *(F.coalesce(c, F.lit("")).alias(c) for c in ("base", "spans")),
    )


def redact(
    docs: DataFrame, rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind in brackets.

    Overlapping spans become one mark, of the kind that begins first.
    """
    keyed = _keyed(docs, id_column, text_column)
    spans = all_spans(keyed.select("doc", "hash", "text"), rounds)
    merged = (
        _islands(spans)
        .groupBy("doc", "hash")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop", "kind"))).alias("__hl_spans"))
        .select(F.col("doc").alias("__hl_doc"), F.col("hash").alias("__hl_hash"), "__hl_spans")
    )
    merged = stored(merged, "pii-merged")
    keys = checked(merged.select("__hl_doc", "__hl_hash"), 1_000_000)
    named = docs.withColumn("__hl_doc", _doc(id_column)).withColumn(
        "__hl_hash", F.xxhash64(F.col(text_column))
    )
    on = ["__hl_doc", "__hl_hash"]
    clean = named.join(keys, on, "left_anti")
    held = named.join(keys, on, "left_semi").join(merged, on)
    text = F.col(text_column)

    def piece(span: Column, i: Column) -> Column:
        at = F.coalesce(F.get("__hl_spans", i - F.lit(1))["stop"], F.lit(0))
        kept = F.substring(text, (at + 1).cast("int"), (span["start"] - at).cast("int"))
        return F.concat(kept, F.lit("["), F.upper(span["kind"]), F.lit("]"))

    last = F.element_at("__hl_spans", -1)["stop"]
    tail = F.substring(text, (last + 1).cast("int"), F.length(text))
    marked = F.concat(F.array_join(F.transform("__hl_spans", piece), ""), tail)
    return (
        held.withColumn(text_column, marked).select(*docs.columns).union(clean.select(*docs.columns))
    )
