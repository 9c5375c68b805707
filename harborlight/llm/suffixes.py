"""Removal of repeated byte strings with suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts elsewhere.
Sorting the suffixes of a whole corpus in one place is not possible, so equal strings
are first brought together:

1. Every string of ``length`` bytes has an anchor, the least of the hashed grams inside
   it.  Neighbouring strings share anchors, so a document becomes runs of strings with
   one anchor.  Equal strings have equal anchors; a run whose anchor occurs only once
   holds nothing that is repeated.
2. The bytes of the other runs are collapsed to distinct segments, first in each task.
3. Segments are dealt into shards by anchor.  A shard's suffix array is built by
   Larsson-Sadakane refinement (groups of equal rank are refined with the rank of the
   suffix h bytes on, h doubling), its common prefixes by Kasai's rule; a string is
   repeated if it has ``length`` bytes in common with a neighbour.
4. An anchor with very many distinct segments is dealt into several shards, and each
   pair of them is merged: the sorted strings of one are found in the other by binary
   search.

Documents are identified by id and a hash of their text, so equal rows count as
occurrences of each other.  Text is shuffled only for documents with a repeated anchor.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` are kept;
repeated rows remove each other; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlight.llm.common import checked, stored
from harborlight.llm.textblocks import GROUP_BYTES, bytes_of, groups, running_sums, stretch_hashes

LENGTH = 200
GRAM = 48
#: bytes of distinct segments that one shard is meant to hold
SHARD_BYTES = 1_500_000
#: distinct segments of one anchor beyond which it is dealt into several shards
ANCHOR_SEGMENTS = 2_000
_PLACE_BITS = np.uint64(24)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, in two accumulated passes over blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchor_runs(
    data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one anchor: row, first start, number, anchor place, anchor.

    Starts and places are counted from the row's first byte.
    """
    parts, row = [], 0
    while row < len(bounds) - 1:
        stop = int(np.searchsorted(bounds, bounds[row] + GROUP_BYTES, "right")) - 1
        if stop > row:  # neighbouring rows together
            part = bounds[row : stop + 1]
            found = _runs(data[part[0] : part[-1]], part - part[0], length, gram)
            parts.append((found[0] + row, *found[1:]))
            row = stop
            continue
        first, end = int(bounds[row]), int(bounds[row + 1])
        for at in range(first, end - length + 1, GROUP_BYTES):  # a very long text in pieces
            piece = data[at : min(at + GROUP_BYTES + length - 1, end)]
            _, start, count, place, anchor = _runs(piece, np.array([0, len(piece)]), length, gram)
            moved = at - first
            parts.append((np.full(len(start), row), start + moved, count, place + moved, anchor))
        row += 1
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (_NONE,) * 5


_NONE = np.empty(0, np.int64)


def _runs(data, bounds, length, gram):
    n = len(data) - length + 1
    if n <= 0:
        return (_NONE,) * 5
    places = np.arange(len(data) - gram + 1)
    hashes = stretch_hashes(running_sums(data), places, places + gram)
    ranked = (hashes >> _PLACE_BITS << _PLACE_BITS) | places.astype(np.uint64)
    least = sliding_min(ranked, length - gram + 1)
    place = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    # only starts whose string stays inside its row
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    left = bounds[row_of + 1] - np.arange(n)
    valid = np.flatnonzero(left >= length)
    if not len(valid):
        return (_NONE,) * 5
    new = np.ones(len(valid), bool)
    new[1:] = (place[valid[1:]] != place[valid[:-1]]) | (valid[1:] != valid[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(valid)))
    start = valid[first]
    row = row_of[start]
    return row, start - bounds[row], count, place[start] - bounds[row], hashes[place[start]].view(np.int64)


# --- one shard ---------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """All suffixes in order; ``text`` holds byte + 1, and 0 where a segment ends.

    Larsson-Sadakane: the rank of a suffix is the last place of its group of suffixes equal
    in h symbols; members of groups are sorted by the rank of the suffix h symbols on.
    Suffixes equal up to the end of their segments are ordered by place at last.
    """
    to_end = _distance_to_end(text)
    packed = _packed(text, to_end)
    order = np.argsort(packed).astype(np.int32)
    rank = _group_ranks(order, packed[order])
    del packed
    h = 7
    while True:
        at = _places_of_groups(rank[order])
        at = at[to_end[order[at]] >= h]  # others met the end: they are sorted
        if not len(at):
            break
        _refine(order, rank, at, rank[order[at] + h])
        h *= 2
    at = _places_of_groups(rank[order])
    if len(at):
        _refine(order, rank, at, order[at])
    return order


def _packed(text: np.ndarray, to_end: np.ndarray) -> np.ndarray:
    """Seven symbols from each place as one number; what follows a segment's end is zero."""
    n = len(text)
    packed = np.zeros(n, np.uint64)
    symbols = np.zeros(n + 7, np.uint64)
    symbols[:n] = text
    for k in range(7):
        packed <<= np.uint64(9)
        packed |= symbols[k : k + n] * (to_end >= k)
    return packed


def _places_of_groups(ranks: np.ndarray) -> np.ndarray:
    """Places in the order whose rank a neighbour shares."""
    same = np.flatnonzero(ranks[1:] == ranks[:-1])
    grouped = np.zeros(len(ranks), bool)
    grouped[same] = True
    grouped[same + 1] = True
    return np.flatnonzero(grouped)


def _refine(order: np.ndarray, rank: np.ndarray, at: np.ndarray, by: np.ndarray) -> None:
    """Sort the members at these places inside their groups, and give them new ranks."""
    members = order[at]
    key = (rank[members].astype(np.uint64) << np.uint64(32)) | by.astype(np.uint64)
    turn = np.argsort(key)
    key = key[turn]
    members = members[turn]
    order[at] = members
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(first, len(key)))
    rank[members] = np.repeat(at[first + sizes - 1], sizes)


def _group_ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(first, len(keys)))
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.repeat(first + sizes - 1, sizes)
    return rank


def _distance_to_end(text: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(text == 0)
    sizes = np.diff(np.append(-1, ends))
    return np.repeat(ends, sizes).astype(np.int32) - np.arange(len(text), dtype=np.int32)


def common_prefixes(
    text: np.ndarray, order: np.ndarray, starts: np.ndarray, counts: np.ndarray, limit: int
) -> np.ndarray:
    """Symbols that suffixes share with their predecessors in ``order``, at most ``limit``.

    Only the first ``counts`` suffixes of each segment are looked at.  Kasai's rule, for all
    segments side by side: from one suffix of a segment to the next the common prefix
    shrinks by one at most, so it only needs to be extended from there: by seven symbols
    as long as seven are equal, then by single ones.
    """
    n = len(text)
    to_end = _distance_to_end(text)
    packed = _packed(text, to_end)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int32)
    by_count = np.argsort(-counts, kind="stable")  # segments that are done drop off the end
    current, left = starts[by_count], -counts[by_count]
    h = np.zeros(len(starts), np.int64)
    for step in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(left, -step))
        at, other = current[:live] + step, before[current[:live] + step]
        depth = np.where(other >= 0, np.maximum(h[:live] - 1, 0), 0)
        growing = tried = np.flatnonzero((other >= 0) & (depth < limit))
        while len(growing):
            a, b = at[growing] + depth[growing], other[growing] + depth[growing]
            growing = growing[(packed[a] == packed[np.minimum(b, n - 1)]) & (to_end[a] >= 7)]
            depth[growing] += 7
            growing = growing[depth[growing] < limit]
        growing = tried[depth[tried] < limit]
        while len(growing):
            a, b = at[growing] + depth[growing], other[growing] + depth[growing]
            fits = (text[a] == text[np.minimum(b, n - 1)]) & (text[a] != 0)
            growing = growing[fits]
            depth[growing] += 1
            growing = growing[depth[growing] < limit]
        shared[at] = h[:live] = np.minimum(depth, limit)
    return shared


def repeated_starts(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (segment, place) of strings that stand in several segments, from a suffix array."""
    if not segments:
        return _NONE, _NONE
    text, starts = _joined(segments)
    order = suffix_array(text)
    counts = np.array([max(len(s) - length + 1, 0) for s in segments], np.int64)
    full = common_prefixes(text, order, starts, counts, length) >= length
    repeated = full.copy()
    repeated[order[:-1]] |= full[order[1:]]
    place = np.flatnonzero(repeated)
    segment = np.searchsorted(starts, place, "right") - 1
    return segment, place - starts[segment]


def _joined(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(s + b"\0" for s in segments), np.uint8)
    text = raw.astype(np.int16) + 1
    ends = np.cumsum([len(s) + 1 for s in segments])
    text[ends - 1] = 0
    return text, np.concatenate([[0], ends[:-1]])


def sorted_strings(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of ``length`` bytes in the order of the suffix array, with segment and place."""
    text, starts = _joined(segments)
    order = suffix_array(text)
    order = order[_distance_to_end(text)[order] >= length]
    body = (text - 1).astype(np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(body, length)
    rows = np.empty((len(order), length + 1), np.uint8)
    rows[:, :length] = view[order]
    rows[:, length] = 1  # a last byte other than zero, so that no zero byte is cut off
    segment = np.searchsorted(starts, order, "right") - 1
    return rows.reshape(-1).view(f"S{length + 1}"), segment, order - starts[segment]


def shared_starts(left: list[bytes], right: list[bytes], length: int):
    """Starts of strings of ``left`` that are in ``right``, and the reverse, by binary search."""
    a, b = sorted_strings(left, length), sorted_strings(right, length)
    out = []
    for x, y in ((a, b), (b, a)):
        at = np.searchsorted(y[0], x[0])
        hit = at < len(y[0])
        hit[hit] = y[0][at[hit]] == x[0][hit]
        out.append((x[1][hit], x[2][hit]))
    return out


def _spans(segment: np.ndarray, place: np.ndarray, n: int, length: int) -> list[bytes]:
    """Covered stretches (start, end) of each segment as packed int32."""
    if not len(place):
        return [b""] * n
    order = np.lexsort((place, segment))
    segment, place = segment[order], place[order]
    new = np.ones(len(place), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (place[1:] > place[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    pairs = np.stack([place[first], place[last] + length], axis=1).astype("<i4")
    cuts = np.searchsorted(segment[first], np.arange(n + 1))
    return [pairs[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _within(keys, bodies, weights, places, length) -> tuple[np.ndarray, np.ndarray]:
    """Repeated starts of one shard; a segment alone at its anchor shares nothing with others."""
    at_anchor = Counter(anchor for anchor, _ in places.values())
    many = [i for i, k in enumerate(keys) if at_anchor[places[k][0]] > 1]
    segment, place = repeated_starts([bodies[keys[i]] for i in many], length)
    again = np.array([i for i, k in enumerate(keys) if weights[k] > 1], np.int64)
    sizes = np.array([len(bodies[keys[i]]) - length + 1 for i in again], np.int64)
    whole = np.repeat(again, sizes)  # equal segments were collapsed before
    offsets = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return (
        np.concatenate([np.array(many, np.int64)[segment], whole]),
        np.concatenate([place, offsets]),
    )


def _shard(length: int):
    def solve(table: pa.Table) -> pa.Table:
        weights: dict[tuple, int] = {}
        bodies: dict[tuple, bytes] = {}
        places: dict[tuple, tuple] = {}
        names = ("anchor", "id1", "id2", "body", "n", "side")
        for anchor, id1, id2, body, n, side in zip(
            *(table.column(c).to_pylist() for c in names), strict=True
        ):
            weights[id1, id2] = weights.get((id1, id2), 0) + n
            bodies[id1, id2] = body
            places[id1, id2] = (anchor, side)
        keys = sorted(bodies)
        if len({side for _, side in places.values()}) < 2:
            found = _within(keys, bodies, weights, places, length)
        else:
            halves = [[i for i, k in enumerate(keys) if places[k][1] == s] for s in (0, 1)]
            pair = shared_starts(*([bodies[keys[i]] for i in half] for half in halves), length)
            found = (
                np.concatenate([np.array(h, np.int64)[x[0]] for h, x in zip(halves, pair, strict=True)]),
                np.concatenate([x[1] for x in pair]),
            )
        spans = _spans(*found, len(keys), length)
        hit = [i for i, s in enumerate(spans) if s]
        return pa.table(
            {
                "id1": pa.array([keys[i][0] for i in hit], pa.int64()),
                "id2": pa.array([keys[i][1] for i in hit], pa.int64()),
                "spans": pa.array([spans[i] for i in hit], pa.binary()),
            }
        )

    return solve


# --- the corpus --------------------------------------------------------------


RUNS = "doc long, hash long, anchor long, start int, n int, lead int, weight int"


def _all_runs(texts: DataFrame, length: int) -> DataFrame:
    """All runs.  An anchor met again in a group of texts is known to repeat: its runs get
    weight 0, and one row without a document carries the weight of two for other groups."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RUNS.split(", ")]
        for batch in batches:
            for part, data, bounds in groups(batch, 2):
                row, start, count, place, anchor = anchor_runs(data, bounds, length)
                distinct, which, n = np.unique(anchor, return_inverse=True, return_counts=True)
                again = distinct[n > 1]
                ids = [part.column(c).take(pa.array(row)) for c in (0, 1)]
                columns = [anchor, start, count, place - start, np.where(n[which] > 1, 0, 1)]
                blank = [pa.nulls(len(again), pa.int64())] * 2
                zeros = np.zeros(len(again), np.int64)
                marks = [again, zeros, zeros, zeros, zeros + 2]
                for keys, values in ((ids, columns), (blank, marks)):
                    arrays = [pa.array(v, k) for v, k in zip(values, [pa.int64()] + [pa.int32()] * 4, strict=True)]
                    yield pa.RecordBatch.from_arrays([*keys, *arrays], names)

    return texts.mapInArrow(scan, RUNS)


def _repeated_runs(texts: DataFrame, length: int) -> DataFrame:
    every = stored(_all_runs(texts, length), "suffix-anchors")
    seen = F.sum("weight").over(Window.partitionBy("anchor"))
    found = every.filter("weight > 0").withColumn("seen", seen).filter("seen > 1 and doc is not null")
    return found.drop("seen").union(every.filter("weight = 0")).drop("weight")


SEGMENTS = (
    "doc long, hash long, start int, anchor long, id1 long, id2 long, n int, body binary"
)


def _segments(held: DataFrame, length: int) -> DataFrame:
    """Per run its segment's identity, and per distinct segment of a task its bytes."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = [f.split()[0] for f in SEGMENTS.split(", ")]

    def made(rows):
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, list] = {}
        for batch in batches:
            for part, data, bounds in groups(batch, 2):
                raw, rows = data.tobytes(), []
                for i, (doc, hashed, runs) in enumerate(
                    zip(*(part.column(c).to_pylist() for c in (0, 1, 3)), strict=True)
                ):
                    for run in runs:
                        at = int(bounds[i]) + run["start"]
                        body = raw[at : at + run["n"] - 1 + length]
                        digest = hashlib.blake2b(body, digest_size=16, salt=run["lead"].to_bytes(4, "little")).digest()
                        id1, id2 = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                        rows.append((doc, hashed, run["start"], None, id1, id2, None, None))
                        known = counts.setdefault((id1, id2), [run["anchor"], 0, body])
                        known[1] += 1
                if rows:
                    yield made(rows)
                if len(counts) > 100_000:
                    yield made([(None, None, None, a, *k, n, b) for k, (a, n, b) in counts.items()])
                    counts.clear()
        if counts:
            yield made([(None, None, None, a, *k, n, b) for k, (a, n, b) in counts.items()])

    return held.mapInArrow(scan, SEGMENTS)


def _removed(marked: DataFrame) -> DataFrame:
    """(doc, hash, n_removed, n_spans, kept_sha256, kept) from texts with their spans."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = bytes_of(batch.column(2))
            out = []
            for i, spans in enumerate(batch.column(3).to_pylist()):
                body = data[bounds[i] : bounds[i + 1]]
                change = np.zeros(len(body) + 1, np.int64)
                for s in spans:
                    pairs = np.frombuffer(s["spans"], "<i4").reshape(-1, 2) + s["start"]
                    np.add.at(change, pairs[:, 0], 1)
                    np.add.at(change, pairs[:, 1], -1)
                gone = np.cumsum(change[:-1]) > 0
                edges = np.count_nonzero(gone[1:] & ~gone[:-1]) + int(len(gone) and gone[0])
                kept = body[~gone].tobytes()
                out.append((int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)]
                + [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc", "hash", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return marked.mapInArrow(
        cut, "doc long, hash long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, hash, spans): for each document with repeats its segments' starts and stretches."""
    runs = _repeated_runs(texts, length)
    by_doc = runs.groupBy("doc", "hash").agg(
        F.collect_set(F.struct("start", "n", "lead", "anchor")).alias("runs")
    )
    by_doc = stored(by_doc, "suffix-by-document")
    few = checked(by_doc.select("doc", "hash"), 1_000_000)
    held = texts.join(few, ["doc", "hash"], "left_semi").join(by_doc, ["doc", "hash"])
    made = stored(_segments(held.select("doc", "hash", "text", "runs"), length), "suffix-segments")
    bodies = stored(
        made.filter("body is not null")
        .groupBy("anchor", "id1", "id2")
        .agg(F.sum("n").alias("n"), F.first("body").alias("body")),
        "suffix-bodies",
    )
    sizes = bodies.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_segments"))
    crowded = stored(sizes.filter(F.col("n_segments") > ANCHOR_SEGMENTS), "suffix-crowded")
    total = bodies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n_shards = -(-total // SHARD_BYTES) + 1
    schema = "id1 long, id2 long, spans binary"
    plain = (
        bodies.join(checked(crowded.select("anchor")), "anchor", "left_anti")
        .withColumn("side", F.lit(0))
        .withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n_shards)))
        .select("shard", "anchor", "id1", "id2", "n", "body", "side")
        .groupBy("shard")
        .applyInArrow(_shard(length), schema)
    )
    # a crowded anchor: every pair of its shards, and every shard by itself
    dealt = bodies.join(checked(crowded), "anchor").withColumn(
        "n_parts", F.ceil(F.col("n_segments") / F.lit(ANCHOR_SEGMENTS)).cast("int")
    )
    part = F.pmod(F.xxhash64("id1", "id2"), F.col("n_parts")).cast("int")
    dealt = dealt.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    )
    pairs = (
        dealt.select(
            "anchor",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "id1", "id2", "n", "body",
            (F.col("part") > F.col("other")).cast("int").alias("side"),
        )
        .groupBy("anchor", "low", "high")
        .applyInArrow(_shard(length), schema)
    )
    spans = stored(plain.union(pairs), "suffix-spans")
    placed = made.filter("body is null").select("doc", "hash", "start", "id1", "id2").join(spans, ["id1", "id2"])
    return placed.groupBy("doc", "hash").agg(F.collect_set(F.struct("start", "spans")).alias("spans"))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, byte counts, the digest of what is kept, and ``kept`` bytes.

    ``kept`` is null where nothing is removed.
    """
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(F.col(text_column)).alias("hash"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    texts = keyed.select("doc", "hash", "text")
    spans = stored(repeated_spans(texts, length), "suffix-found")
    few = checked(spans.select("doc", "hash"), 1_000_000)
    marked = texts.join(few, ["doc", "hash"], "left_semi")
    removed = _removed(marked.join(spans, ["doc", "hash"]).select("doc", "hash", "text", "spans"))
    removed = removed.dropDuplicates(["doc", "hash"])
    whole = keyed.select(
        "doc_id",
        "doc",
        "hash",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text"), 256).alias("whole_sha256"),
    )
    return whole.join(removed, ["doc", "hash"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept",
    )
