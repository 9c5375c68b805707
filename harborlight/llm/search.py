"""Ranked lexical search by range-maximum queries over posting lists.

1. Index: tasks turn their documents into shards, each with the posting lists of the terms
   that items ask for (document ordinal and occurrences, documents by length), and store
   them.  A shard is bounded by postings and documents, whatever the table's size.
2. Statistics: documents, terms and document frequencies are summed over the shards; only
   the frequencies of asked terms reach the driver.
3. Search: every posting gets its impact on the score, every posting list a sparse table of
   range maxima (positions, in levels of doubling width).  For an item, the sum over its
   terms of the greatest impact inside an interval of documents bounds every score there.
   The best intervals are taken first and split at the document of greatest single impact,
   which is scored; intervals of few documents are scored whole.  Intervals whose bound is
   below the tenth best score so far are never opened.  A task keeps its best documents per
   item from shard to shard, so later shards start with a high bar.
4. Merge: the best documents per item and task are ranked once more.

Items are the query set: they are taken in blocks of at most about ``BLOCK_TERMS`` (item,
term) pairs, and each block is searched over all documents.  No hot key exists: shards
follow the partitions of the scan, and the final ranking sees ``top`` rows per item and task.

Terms are compared by 64-bit hashes.  Scores are exact 64-bit integers.

Defined cases: null and empty texts have no terms and do not count as documents; rows of one
item_id (null included) are one item with the terms of all its texts; an item without terms,
or whose terms no document holds, has no rows; equal documents are separate and ranked by
doc_id, those without id last; an empty table on either side gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborlight.llm.common import alnum_words, ascii_lower, stored, text_or_empty
from harborlight.llm.textblocks import NON_ALNUM, groups, word_hashes

#: (item, term) pairs of the items that are searched together
BLOCK_TERMS = 500_000
#: postings and documents of a shard, about
SHARD_POSTINGS = 250_000
SHARD_DOCS = 32_768
#: intervals of so many documents begin a search; those of at most LEAF_DOCS are scored whole
FIRST_DOCS = 512
LEAF_DOCS = 64
#: intervals that are opened together
OPENED = 64

SHARDS = (
    "n_docs long, n_terms long, ids array<long>, lengths binary, terms binary, bounds binary,"
    " docs binary, counts binary"
)


def item_terms(items: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of every item."""
    words = F.transform(alnum_words(text_or_empty(text_column)), ascii_lower)
    return items.select(
        F.col(item_column).cast("string").alias("item_id"), F.explode(words).alias("term")
    ).distinct()


def hashed(terms: list[str]) -> np.ndarray:
    """The hashes of terms as they are found in texts."""
    raw = [t.encode() for t in terms]
    bounds = np.cumsum([0] + [len(r) for r in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds, breaks=NON_ALNUM)[0]


class _Chunk:
    """Documents of a task until they make a shard."""

    def __init__(self, vocabulary: np.ndarray) -> None:
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.ids: list[pa.Array] = []
        self.lengths: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.n_docs = self.n_postings = self.seen_docs = self.seen_terms = 0

    def add(self, ids: pa.Array, data: np.ndarray, bounds: np.ndarray) -> None:
        words, ends = word_hashes(data, bounds, breaks=NON_ALNUM)
        lengths = np.diff(ends)
        self.seen_docs += int(np.count_nonzero(lengths))
        self.seen_terms += len(words)
        found = np.searchsorted(self.vocabulary, words)
        found[found == len(self.vocabulary)] = 0
        asked = self.vocabulary[found] == words
        doc = np.repeat(np.arange(len(lengths)), lengths)[asked]
        held, doc = np.unique(doc, return_inverse=True)
        key = found[asked] << 32 | (doc + self.n_docs)
        key, counts = np.unique(key, return_counts=True)
        self.ids.append(ids.take(pa.array(held)))
        self.lengths.append(lengths[held])
        self.keys.append(key)
        self.counts.append(counts)
        self.n_docs += len(held)
        self.n_postings += len(key)

    def shard(self) -> pa.RecordBatch:
        """The shard of all documents added; they are ordered by length, then id."""
        empty = np.empty(0, np.int64)
        ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], pa.int64())
        lengths, key, counts = (
            np.concatenate(x) if x else empty for x in (self.lengths, self.keys, self.counts)
        )
        by_id = ids.fill_null(2**63 - 1).to_numpy()
        order = np.lexsort((by_id, lengths))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        key = key >> 32 << 32 | place[key & 0xFFFFFFFF]
        sorting = np.argsort(key)
        key, counts = key[sorting], counts[sorting]
        terms, starts = np.unique(key >> 32, return_index=True)
        packed = (
            lengths[order].astype("<i8"),
            terms.astype("<i4"),
            np.append(starts, len(key)).astype("<i4"),
            (key & 0xFFFFFFFF).astype("<i4"),
            counts.astype("<i4"),
        )
        ids = ids.take(pa.array(order))
        columns = [
            pa.array([self.seen_docs], pa.int64()),
            pa.array([self.seen_terms], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(pa.array([x.tobytes()], pa.binary()) for x in packed),
        ]
        names = [c.split()[0] for c in SHARDS.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)


def index(docs: DataFrame, vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stored shards with the posting lists of the terms of ``vocabulary``, a broadcast array."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(vocabulary.value)
        for batch in batches:
            for part, data, bounds in groups(batch, 1):
                chunk.add(part.column(0), data, bounds)
                if chunk.n_postings >= SHARD_POSTINGS or chunk.n_docs >= SHARD_DOCS:
                    yield chunk.shard()
                    chunk.clear()
        if chunk.seen_docs:
            yield chunk.shard()

    chosen = docs.select(F.col(id_column).cast("long"), F.col(text_column))
    return stored(chosen.mapInArrow(build, SHARDS), "search-shards")


def document_frequencies(shards: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for terms, bounds in zip(batch.column(0), batch.column(1), strict=True):
                terms, bounds = (np.frombuffer(x.as_buffer(), "<i4") for x in (terms, bounds))
                total[terms] += np.diff(bounds)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], ["term", "df"])

    counted = shards.select("terms", "bounds").mapInArrow(count, "term long, df long")
    summed = counted.groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[summed.column("term").to_numpy()] = summed.column("df").to_numpy()
    return out


@dataclass(frozen=True)
class Queries:
    """A block of items: terms of item i are ``terms[bounds[i]:bounds[i + 1]]``."""

    items: list
    bounds: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # by term
    n_docs: int
    n_terms: int
    top: int


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of terms that occur, else 0."""
    n = 2 * n_docs + 2
    return np.array([math.floor(1000 * math.log(n / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)


def length_norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """10 + (90 n N) div L, also where the product exceeds 64 bits."""
    if len(lengths) and 90 * n_docs * int(lengths.max()) >= 2**63:
        return np.array([10 + 90 * x * n_docs // n_terms for x in lengths.tolist()], np.int64)
    return 10 + 90 * n_docs * lengths // max(n_terms, 1)


class Shard:
    """One shard's posting lists with impacts and their sparse tables of range maxima."""

    def __init__(self, row: dict[str, np.ndarray], queries: Queries) -> None:
        self.n_docs = len(row["lengths"])
        self.terms, bounds = row["terms"], row["bounds"].astype(np.int64)
        sizes = np.diff(bounds)
        # keys ascend through all lists, so one binary search serves every list
        self.keys = np.repeat(np.arange(len(sizes)), sizes) * self.n_docs + row["docs"]
        norms = length_norms(row["lengths"], queries.n_docs, queries.n_terms)[row["docs"]]
        tf = row["counts"].astype(np.int64)
        weight = np.repeat(queries.weights[self.terms], sizes)
        self.impacts = weight * (1_000_000_000 * tf // (1000 * tf + 8 * norms))
        self.levels = [np.arange(len(self.keys), dtype=np.int32)]
        width = 1
        while 2 * width <= sizes.max(initial=0):
            below = self.levels[-1]
            a, b = below[:-width], below[width:]
            self.levels.append(np.where(self.impacts[b] > self.impacts[a], b, a))
            width *= 2

    def lists(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The lists of an item's terms that this shard has and that weigh anything."""
        if not len(self.terms):
            return np.empty(0, np.int64)
        found = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return found[(self.terms[found] == terms) & (weights[terms] > 0)]

    def maxima(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest impact, and its position, of every list (rows) in every interval (columns)."""
        base = lists[:, None] * self.n_docs
        a = np.searchsorted(self.keys, base + low)
        b = np.searchsorted(self.keys, base + high)
        level = np.zeros(a.shape, np.int64)
        some = b > a
        level[some] = np.log2((b - a)[some]).astype(np.int64)
        at = np.zeros(a.shape, np.int64)
        for k in np.unique(level[some]):
            here = some & (level == k)
            x, y = self.levels[k][a[here]], self.levels[k][b[here] - (1 << k)]
            at[here] = np.where(self.impacts[y] > self.impacts[x], y, x)
        return np.where(some, self.impacts[at], 0), at

    def scores(self, lists: np.ndarray, docs: np.ndarray) -> np.ndarray:
        wanted = lists[:, None] * self.n_docs + docs
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.impacts[at], 0).sum(axis=0)

    def scored_whole(self, lists: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all documents inside intervals that hold a term."""
        base = lists[:, None] * self.n_docs
        a = np.searchsorted(self.keys, base + low).ravel()
        n = np.searchsorted(self.keys, base + high).ravel() - a
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        docs, place = np.unique(self.keys[at] % self.n_docs, return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, place, self.impacts[at])
        return docs, scores

    def search(self, lists: np.ndarray, best: Best) -> None:
        """Offer ``best`` every document that can be among the best of an item."""
        low = np.arange(0, self.n_docs, FIRST_DOCS)
        high = np.minimum(low + FIRST_DOCS, self.n_docs)
        values, at = self.maxima(lists, low, high)
        while True:
            bound = values.sum(axis=0)
            open_ = bound >= max(best.bar, 1)
            if not open_.any():
                return
            low, high, bound, values, at = low[open_], high[open_], bound[open_], values[:, open_], at[:, open_]
            first = np.argsort(-bound, kind="stable")
            taken, rest = first[:OPENED], first[OPENED:]
            small = taken[high[taken] - low[taken] <= LEAF_DOCS]
            large = taken[high[taken] - low[taken] > LEAF_DOCS]
            if len(small):
                best.offer(*self.scored_whole(lists, low[small], high[small]))
            kept = [(low[rest], high[rest], values[:, rest], at[:, rest])]
            if len(large):
                strongest = values[:, large].argmax(axis=0)
                middle = self.keys[at[strongest, large]] % self.n_docs
                best.offer(middle, self.scores(lists, middle))
                lows = np.concatenate([low[large], middle + 1])
                highs = np.concatenate([middle, high[large]])
                some = highs > lows
                kept.append((lows[some], highs[some], *self.maxima(lists, lows[some], highs[some])))
            low, high = (np.concatenate([k[i] for k in kept]) for i in (0, 1))
            values, at = (np.concatenate([k[i] for k in kept], axis=1) for i in (2, 3))


class Best:
    """The best documents of one item: score first, then the smaller id."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.bar = 0  # no document below this score is wanted
        self.ids = np.empty(0, np.int64)
        self.scores = np.empty(0, np.int64)
        self.names = self.ids

    def begin(self, names: np.ndarray) -> None:
        """``names``: ids by document ordinal of the shard that is searched next."""
        self.names = names

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= max(self.bar, 1)
        if not good.any():
            return
        ids = np.concatenate([self.ids, self.names[docs[good]]])
        scores = np.concatenate([self.scores, scores[good]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.top:
            self.bar = int(self.scores[-1])


#: stands for a missing id, after all others
_NO_ID = 2**63 - 1


def _searched(shards: DataFrame, queries) -> DataFrame:
    """(item, doc_id, score): the best documents of every item in every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Queries = queries.value
        best: dict[int, Best] = {}
        kinds = {"lengths": "<i8", "terms": "<i4", "bounds": "<i4", "docs": "<i4", "counts": "<i4"}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in kinds.items()}
                names = batch.column("ids")[i].values.fill_null(_NO_ID).to_numpy()
                shard = Shard(row, asked)
                for item in range(len(asked.items)):
                    terms = asked.terms[asked.bounds[item] : asked.bounds[item + 1]]
                    lists = shard.lists(terms, asked.weights)
                    if len(lists):
                        if item not in best:
                            best[item] = Best(asked.top)
                        best[item].begin(names)
                        shard.search(lists, best[item])
        for item, found in best.items():
            n = len(found.ids)
            ids = pa.array(found.ids, mask=found.ids == _NO_ID)
            columns = [pa.array([asked.items[item]] * n, pa.string()), ids, pa.array(found.scores)]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    chosen = shards.select("ids", "lengths", "terms", "bounds", "docs", "counts")
    return chosen.mapInArrow(run, "item_id string, doc_id long, score long")


def _block(terms: DataFrame) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Items, bounds and term numbers of a block, and the sorted vocabulary of hashes."""
    table = terms.orderBy("item_id", "term").toArrow()
    names = table.column("item_id").to_pylist()
    hashes = hashed(table.column("term").to_pylist())
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    first = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
    bounds = np.array([*first, len(names)])
    return [names[i] for i in first], bounds, numbers, vocabulary


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_column), "search-terms")
    kind = items.schema[item_column].dataType
    n_blocks = -(-asked.count() // BLOCK_TERMS)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(n_blocks, 1)))
    found = None
    for number in range(n_blocks):
        names, bounds, terms, vocabulary = _block(asked.filter(block == number))
        if not names:
            continue
        shards = index(docs, spark.sparkContext.broadcast(vocabulary), id_column, text_column)
        n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_docs:
            break
        weights = term_weights(document_frequencies(shards, len(vocabulary)), n_docs)
        queries = Queries(names, bounds, terms, weights, n_docs, n_terms, top)
        part = stored(_searched(shards, spark.sparkContext.broadcast(queries)), "search-best")
        found = part if found is None else found.union(part)
    if found is None:
        found = spark.createDataFrame([], "item_id string, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
