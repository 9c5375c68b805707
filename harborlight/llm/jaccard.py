"""Exact set-similarity self-join on word shingles, answered as components.

Documents with equal shingle sets form one class.  Classes are joined through inverted
lists of prefix tokens under one global order: frequent tokens last, others by hash.
(Any fixed order gives exact results; frequencies only make the lists short.)

* Index-level skipping: list entries carry set size and position; entries are paired only
  inside the size bound, and blocks of entries are skipped when the tokens left after
  their positions cannot reach the needed overlap.  Entries that no other entry of their
  list fits by size are dropped before lists are stored, as lists of chance matches grow
  faster than the documents.
* Before sets are sent to each other, the counts of their members in 512 ranges of hashes
  bound how many they can share; pairs below the needed overlap go no further.
* Answer-level skipping: the sets of a list are first compared with two leaders per size
  band only, one of them the most typical set.  The answers of a leader are then used for the highly similar sets around
  it: sets that are already connected need no comparison, and two sets whose known
  differences to a shared leader differ by more than the bound cannot be linked.  Only
  pairs that neither rule settles are compared, so no list is expanded into all its
  pairs, and no link between components is lost.

Shingles are 64-bit hashes; sets are compared by their hashes.

Defined cases: null, empty and blank texts have no shingles, are linked with nothing and
are components of their own; a text with fewer words than a shingle is one shingle;
repeated rows have equal results, rows of one id count as one document; rows without id
are linked with nothing and have no component; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlight.llm.common import checked, stored
from harborlight.llm.components import components
from harborlight.llm.textblocks import (
    groups,
    most_shared,
    set_signatures,
    set_sketches,
    shingle_sets,
    word_hashes,
)

#: shingles of a chunk in which token frequencies are counted
CHUNK = 1_000_000
#: sets a task remembers so as not to send copies again; copies it forgot are merged later
SEEN_SETS = 100_000
#: a token is counted when so many documents of a chunk hold it
COUNTED_FROM = 3
#: so many of the most frequent tokens are ordered last; others are ordered by hash
FREQUENT_TOKENS = 500_000
#: rounds in which lists draw leaders of their own before the remaining pairs are compared
DRAWN_ROUNDS = 1


def _signatures(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, n, k1, k2, sketch) per document; per chunk (k1 = token, n, no sketch) of tokens
    seen repeatedly."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for batch in batches:
            for part, data, bounds in groups(batch, 1):
                sets, ends = shingle_sets(*word_hashes(data, bounds), length)
                k1, k2 = set_signatures(sets, ends)
                yield _record(part.column(0), np.diff(ends), k1, k2, *set_sketches(sets, ends))
                chunk.append(sets)
                held += len(sets)
                if held >= CHUNK:
                    yield from _counted(chunk)
                    chunk, held = [], 0
        yield from _counted(chunk)

    return docs.mapInArrow(scan, "doc_id long, n long, k1 long, k2 long, sketch binary, coarse array<tinyint>")


def _record(
    ids: pa.Array, n: np.ndarray, k1: np.ndarray, k2: np.ndarray, sketches: list, coarse: list
) -> pa.RecordBatch:
    arrays = [ids, *(pa.array(x, pa.int64()) for x in (n, k1, k2)), pa.array(sketches, pa.binary())]
    arrays.append(pa.array(coarse, pa.list_(pa.int8())))
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "k1", "k2", "sketch", "coarse"])


def _counted(chunk: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if chunk:
        tokens, n = np.unique(np.concatenate(chunk), return_counts=True)
        tokens, n = tokens[n >= COUNTED_FROM], n[n >= COUNTED_FROM]
        if len(tokens):
            nothing, none = pa.nulls(len(n), pa.int64()), [None] * len(n)
            yield _record(nothing, n, tokens.view(np.int64), np.zeros(len(n), np.int64), none, none)


def _frequent(signatures: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, ascending, and their frequency classes."""
    counts = signatures.filter("sketch is null").groupBy("k1").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "k1").limit(FREQUENT_TOKENS).toArrow()
    tokens = top.column("k1").to_numpy().view(np.uint64)
    classes = np.log2(np.maximum(top.column("n").to_numpy(), 1)).astype(np.int64) + 1
    order = np.argsort(tokens)
    return tokens[order], classes[order]


def _ceil_share(n: np.ndarray, part: int, whole: int) -> np.ndarray:
    return -(-n * part // whole)


def _postings(docs: DataFrame, length: int, percent: int, frequent) -> DataFrame:
    """(token, k1, n, at, is_short): the prefix tokens of each distinct set of a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, heavy_class = frequent.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, data, bounds in groups(batch, 1):
                sets, ends = shingle_sets(*word_hashes(data, bounds), length)
                k1, k2 = set_signatures(sets, ends)
                n = np.diff(ends)
                fresh = np.zeros(len(n), bool)
                for i, pair in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                    if n[i] and pair not in seen:
                        fresh[i] = True
                        seen.add(pair)
                if len(seen) > SEEN_SETS:
                    seen.clear()
                rows = np.repeat(np.arange(len(n)), n)
                found = np.searchsorted(heavy, sets) if len(heavy) else np.zeros(len(sets), int)
                found = np.minimum(found, max(len(heavy) - 1, 0))
                classes = (
                    np.where(heavy[found] == sets, heavy_class[found], 0)
                    if len(heavy)
                    else np.zeros(len(sets), np.int64)
                )
                # already by hash inside each row, so a stable sort by row and class is enough
                order = np.argsort(rows * 64 + classes, kind="stable")
                at = np.arange(len(sets)) - ends[:-1][rows]
                probe = n - _ceil_share(n, percent, 100) + 1
                short = n - _ceil_share(n, 2 * percent, 100 + percent) + 1
                kept = fresh[rows] & (at < probe[rows])
                row, at = rows[kept], at[kept]
                arrays = [sets[order][kept].view(np.int64), k1[row], n[row], at]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(a, pa.int64()) for a in arrays), pa.array(at < short[row])],
                    ["token", "k1", "n", "at", "is_short"],
                )

    return docs.mapInArrow(scan, "token long, k1 long, n long, at long, is_short boolean")


def _partnered(entries: DataFrame, percent: int) -> DataFrame:
    """Each set once per list, with ``n_list``, the sets in it; only sets with another of the list
    inside the size bound.  ``may_link`` tells those that ``_can_link`` may admit to a pair.

    Of two linked sets the smaller is met in its short prefix.  So an entry may link if the
    largest smaller one that is short, or the next larger one if it is short itself, is
    inside the size bound; equal sizes count as smaller and larger.
    """
    by_size = Window.partitionBy("token").orderBy("n", F.desc("is_short"), "k1")
    whole = by_size.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    again = (F.lag("k1").over(by_size) == F.col("k1")) & (F.lag("n").over(by_size) == F.col("n"))
    once = entries.withColumn("again", F.coalesce(again, F.lit(False))).filter("not again").drop("again")
    seen = once.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("n_list"),
        F.lag("n").over(by_size).alias("smaller"),
        F.max(F.when(F.col("is_short"), F.col("n"))).over(before).alias("short"),
        F.lead("n").over(by_size).alias("larger"),
    )
    below, above = 100 * F.col("smaller") >= percent * F.col("n"), 100 * F.col("n") >= percent * F.col("larger")
    may_link = (100 * F.col("short") >= percent * F.col("n")) | (F.col("is_short") & above)
    return seen.filter(below | above).select(
        "token", "k1", "n", "at", "is_short", "n_list", F.coalesce(may_link, F.lit(False)).alias("may_link")
    )


def _sets(docs: DataFrame, length: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in groups(batch, 1):
                sets, ends = shingle_sets(*word_hashes(data, bounds), length)
                raw = [sets[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(raw, pa.binary())], ["id", "tokens"]
                )

    return docs.mapInArrow(scan, "id long, tokens binary")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches allow the needed overlap; no pair that is linked is lost."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [
                (100 + percent) * most_shared(x, y) >= percent * (n + m)
                for x, y, n, m in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
            ]
            chosen = batch.filter(pa.array(kept, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], ["a", "b"])

    named = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "jaccard-named")
    classes = classes.join(checked(named, 1_000_000), "id", "left_semi")
    sides = [
        classes.select(F.col("id").alias(s), F.col("sketch").alias(f"sketch_{s}"), F.col("n").alias(f"n_{s}"))
        for s in ("a", "b")
    ]
    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    joined = joined.select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b")
    return joined.mapInArrow(test, "a long, b long").distinct()


def _compare(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, length: int, percent: int
) -> DataFrame:
    """(a, b, n_a, n_b, shared, is_link) of candidate pairs, by intersecting their sets."""
    pairs = stored(_possible(pairs, classes, percent), "jaccard-possible")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = stored(wanted, "jaccard-wanted")
    texts = docs.join(checked(wanted, 1_000_000), docs["doc_id"] == wanted["id"], "left_semi")
    sets = stored(_sets(texts, length), "jaccard-sets")
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tokens_b"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(*(batch.column(i) for i in (2, 3)), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append((len(x), len(y), shared, 100 * shared >= percent * (len(x) + len(y) - shared)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["a", "b", "n_a", "n_b", "shared", "is_link"],
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")
    return joined.mapInArrow(count, "a long, b long, n_a long, n_b long, shared long, is_link boolean")


def _can_link(percent: int, x: str, y: str):
    """Size and positional bound of entries ``x`` and ``y`` of one list; y is not the larger."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    rest = F.least(nx - F.col(f"{x}.at"), ny - F.col(f"{y}.at"))
    sizes = (100 * ny >= percent * nx) & (ny <= nx)
    return sizes & F.col(f"{y}.is_short") & (rest * (100 + percent) >= percent * (nx + ny))


def _leader_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each entry with the leaders of its list and size band: the least set and the most typical.

    The fewer words of its own a set has, the longer are the lists of its prefix; so of near
    copies the one that the others were made from leads, or one close to it.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent))
    banded = lists.withColumn("band", band)
    entry = [F.col(c) for c in ("n", "id", "at", "is_short")]
    by_typical = F.struct((-F.col("typical")).alias("t"), F.xxhash64("id").alias("h"), *entry)
    leaders = banded.groupBy("token", "band").agg(
        F.min(F.struct(*entry)).alias("least"), F.min(by_typical).alias("most")
    )
    sides = F.array("least", F.struct(*(F.col("most")[c].alias(c) for c in ("n", "id", "at", "is_short"))))
    pairs = banded.join(leaders, ["token", "band"]).select(
        F.struct(*entry).alias("x"), F.explode(sides).alias("y")
    )
    possible = _can_link(percent, "x", "y") | _can_link(percent, "y", "x")
    return pairs.filter(possible & (F.col("x.id") != F.col("y.id"))).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()


def _mixed(lists: DataFrame, classes: DataFrame, roots: DataFrame, tested: DataFrame) -> DataFrame:
    """Entries of lists that hold several components, with component, major component, the
    set's closest leader and its members' counts in 64 ranges."""
    both = tested.select(F.col("a").alias("id"), F.col("b").alias("pivot"), "n_a", "n_b", "shared").union(
        tested.select("b", "a", "n_a", "n_b", "shared")
    )
    gap = (F.col("n_a") + F.col("n_b") - 2 * F.col("shared")).alias("gap")
    nearest = both.groupBy("id").agg(F.min(F.struct(gap, "pivot")).alias("nearest"))
    placed = (
        lists.join(roots.withColumnRenamed("node", "id"), "id", "left")
        .join(nearest, "id", "left")
        .select(
            "token", "id", "n", "at", "is_short",
            F.coalesce("root", "id").alias("root"),
            F.col("nearest.pivot").alias("pivot"), F.col("nearest.gap").alias("gap"),
        )
    )
    placed = stored(placed, "jaccard-placed")
    sizes = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("n_root"))
    several = sizes.groupBy("token").agg(
        F.max(F.struct("n_root", "root"))["root"].alias("major"), F.count(F.lit(1)).alias("n_roots")
    ).filter("n_roots > 1")
    mixed = placed.join(several.select("token", "major"), "token")
    return stored(mixed.join(classes.select("id", "coarse"), "id"), "jaccard-mixed")


def _apart(percent: int):
    """Known differences to one leader that rule a link out, by the triangle inequality."""
    bound = (100 - percent) * (F.col("x.n") + F.col("y.n"))
    apart = (F.col("x.pivot") == F.col("y.pivot")) & (
        (100 + percent) * F.abs(F.col("x.gap") - F.col("y.gap")) > bound
    )
    return F.coalesce(apart, F.lit(False))


def _may_share_enough(percent: int):
    """Whether the counts of both sets' members in ranges of hashes allow the needed overlap."""
    least = F.zip_with("x.coarse", "y.coarse", lambda a, b: F.least(a, b).cast("int"))
    most = F.aggregate(least, F.lit(0), lambda total, c: total + c)
    enough = most * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n"))
    return F.coalesce(enough, F.lit(True))  # very large sets have no counts


def _pairs(joined: DataFrame, tested: DataFrame) -> DataFrame:
    pairs = joined.select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def _own_leader_pairs(mixed: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Untested pairs of each entry with the leader that its list alone draws by a hash.

    Lists draw different leaders, so a group of near copies whose members are linked only
    here and there is met from many sides; the pairs are no more than the entries.
    """
    entry = [F.col(c) for c in ("id", "n", "at", "is_short", "root", "pivot", "gap", "coarse")]
    drawn = F.min(F.struct(F.xxhash64("token", "id").alias("h"), *entry)).alias("y")
    leaders = mixed.groupBy("token").agg(drawn)
    joined = mixed.select("token", F.struct(*entry).alias("x")).join(leaders, "token")
    possible = (_can_link(percent, "x", "y") | _can_link(percent, "y", "x")) & ~_apart(percent)
    open_pairs = joined.filter((F.col("x.root") != F.col("y.root")) & possible)
    return _pairs(open_pairs.filter(_may_share_enough(percent)), tested)


def _open_pairs(mixed: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Pairs of list entries that are in different components and that no bound rules out."""
    x = mixed.filter("root <> major").alias("x")
    y = mixed.alias("y")
    joined = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.root") != F.col("y.root"))
        & (_can_link(percent, "x", "y") | _can_link(percent, "y", "x"))
        & ~_apart(percent)
        & _may_share_enough(percent),
    )
    return _pairs(joined, tested)


def near_duplicates(
    docs: DataFrame,
    length: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, class_id (least id with an equal set) and component_id per row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    scanned = stored(_signatures(docs, length), "jaccard-signatures")
    frequent = spark.sparkContext.broadcast(_frequent(scanned))
    each = scanned.filter("sketch is not null")
    classes = stored(
        each.filter("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(
            F.min("doc_id").alias("id"),
            F.first("sketch").alias("sketch"),
            F.first("coarse").alias("coarse"),
        ),
        "jaccard-classes",
    )
    entries = _postings(docs.filter("doc_id is not null"), length, percent, frequent)
    # copies met by several tasks are one entry; k1 and n tell sets apart, k2 would double the key
    typical = F.sum("n_list").over(Window.partitionBy("k1", "n")) / F.col("n")
    lists = (
        _partnered(entries, percent)
        .withColumn("typical", typical)
        .filter("may_link")
        .join(classes.select("k1", "n", "id"), ["k1", "n"])
        .select("token", "id", "n", "at", "is_short", "typical")
    )
    lists = stored(lists, "jaccard-lists")
    first = stored(_leader_pairs(lists, percent), "jaccard-leaders")
    tested = stored(_compare(first, classes, docs, length, percent), "jaccard-tested")
    links = tested.filter("is_link").select("a", "b")
    roots = stored(components(links), "jaccard-roots")
    for _ in range(DRAWN_ROUNDS):
        mixed = _mixed(lists, classes, roots, tested)
        drawn = stored(_own_leader_pairs(mixed, tested, percent), "jaccard-drawn")
        if not drawn.take(1):
            break
        found = stored(_compare(drawn, classes, docs, length, percent), "jaccard-tested")
        tested = stored(tested.union(found), "jaccard-tested-so-far")
        if found.filter("is_link").take(1):
            links = tested.filter("is_link").select("a", "b")
            roots = stored(components(links), "jaccard-roots")
    rest = stored(_open_pairs(_mixed(lists, classes, roots, tested), tested, percent), "jaccard-open")
    more = stored(_compare(rest, classes, docs, length, percent), "jaccard-more")
    late = more.filter("is_link").select("a", "b")
    if late.take(1):
        roots = stored(components(links.union(late)), "jaccard-final")
    named = classes.join(roots, classes["id"] == roots["node"], "left").select(
        "k1", "k2", "n", "id", F.coalesce("root", "id").alias("root")
    )
    return each.join(named, ["k1", "k2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame,
    length: int = 3,
    percent: int = 90,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with only the rows of the least id of each component; columns as they were.

    Rows without an id are kept.
    """
    found = near_duplicates(docs, length, percent, id_column, text_column)
    dropped = stored(
        found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__hl_id")).distinct(),
        "jaccard-dropped",
    )
    same = docs[id_column].cast("long") == dropped["__hl_id"]
    return docs.join(checked(dropped, 1_000_000), same, "left_anti")
