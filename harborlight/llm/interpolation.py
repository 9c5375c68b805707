"""Language-model scores by deleted interpolation.

The model mixes the maximum-likelihood estimate of a word after its predecessor with the
smoothed estimate of the word alone:

    P(w | v) = g * c(v, w) / c(v) + (1 - g) * P(w),   P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

The weight g depends on the bucket of the context's frequency, floor(log2 c(v)), and is
learned by expectation-maximisation on one fold of the training documents, with the
counts of the other folds (the fold's own counts are deleted from the totals).

How counts travel: documents are dealt into blocks by a hash; a block asks for the counts
of its distinct words and pairs, split by key range into shards; a shard adds up what
all blocks contribute and answers each block in the order of its keys.  Keys are sent
once per block, however often they occur, so no frequent word makes a hot task, and both
blocks and shards hold a bounded number of bytes.  Only the weights' statistics
reach the driver: frequency buckets by bins of the likelihood ratio, a fixed number.

Words are runs of non-blanks, A-Z lower-cased, known by 64-bit hashes; each text ends with
one end token.  Defined cases: a null, empty or blank text is one end token; repeated
rows are counted each; rows without id have no held-out flag, are not learned from and
are scored; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.llm.common import stored
from harborlight.llm.textblocks import bytes_of, mixed, word_hashes

BLOCK_BYTES = 4_000_000
#: tokens asked for, in all blocks together, by which the number of shards is chosen
SHARD_TOKENS = 2_000_000
FOLDS = 5
TEST_FOLD = 1
#: training fold on which the weights are learned
WEIGHT_FOLD = 0
BUCKETS = 64
BINS_PER_OCTAVE = 16
OCTAVES = 64
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Model:
    """Corpus totals and the weight of each frequency bucket."""

    n_tokens: int
    n_types: int
    n_rest: int
    weights: tuple[float, ...]


@dataclass
class _Block:
    """Tokens of a block's documents as places among its distinct words and pairs."""

    bounds: np.ndarray
    folds: np.ndarray
    words: np.ndarray
    word_at: np.ndarray
    pairs: np.ndarray
    pair_at: np.ndarray
    context_at: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def per_row(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.bounds[:-1]) if len(self.bounds) > 1 else values[:0]


DEALT = "block long, ids array<long>, folds array<int>, sizes array<long>, texts binary"


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a batch by block, compressed together; text moves three times."""
    schema = pa.schema(
        [("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("folds", pa.list_(pa.int32())),
         ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())]
    )
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(blocks[order]) != 0))
        for rows in np.split(order, cuts[1:]):
            if not len(rows):
                continue
            part = batch.take(pa.array(rows))
            data, bounds = bytes_of(part.column(3))
            row = {
                "block": int(blocks[rows[0]]),
                "ids": part.column(1).to_pylist(),
                "folds": part.column(2).to_pylist(),
                "sizes": np.diff(bounds).tolist(),
                "texts": zlib.compress(data.tobytes(), 1),
            }
            yield pa.RecordBatch.from_pylist([row], schema=schema)


def _joined(table: pa.Table, column: str) -> list:
    return [x for row in table.column(column).to_pylist() for x in row]


def _read(table: pa.Table) -> _Block:
    data = np.frombuffer(b"".join(map(zlib.decompress, table.column("texts").to_pylist())), np.uint8)
    text_bounds = np.append(0, np.cumsum(np.array(_joined(table, "sizes"), np.int64)))
    hashes, ends = word_hashes(data, text_bounds)
    n = len(ends) - 1
    bounds = ends + np.arange(n + 1)  # one end token behind each text
    tokens = np.full(bounds[-1], END, np.uint64)
    is_word = np.ones(len(tokens), bool)
    is_word[bounds[1:] - 1] = False
    tokens[is_word] = hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = START
    pairs = mixed(before * _PAIR + tokens)
    words, word_at = np.unique(tokens, return_inverse=True)
    pairs, pair_at = np.unique(pairs, return_inverse=True)
    # a text's start is met as often as a text's end
    context = np.where(before == START, END, before)
    folds = np.array(_joined(table, "folds"), np.int64)
    return _Block(bounds, folds, words, word_at, pairs, pair_at, np.searchsorted(words, context))


ASKED = "kind int, shard int, block long, keys binary, train binary, fold binary"
ANSWERED = (
    "kind int, shard int, block long, train binary, fold binary, total long, rest long, types long"
)


def _ask(n_shards: int):
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        block = _read(table)
        fold = block.folds[block.rows]
        learned = ((fold >= 0) & (fold != TEST_FOLD)).astype(np.int64)
        deleted = (fold == WEIGHT_FOLD).astype(np.int64)
        out = []
        for kind, keys, at in ((1, block.words, block.word_at), (2, block.pairs, block.pair_at)):
            train = np.bincount(at, learned, len(keys)).astype("<i4")
            held = np.bincount(at, deleted, len(keys)).astype("<i4")
            cuts = np.searchsorted(keys, _limits(n_shards))
            for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if a < b:
                    counts = (zlib.compress(x[a:b].tobytes(), 1) for x in (train, held))
                    out.append((kind, shard, key[0].as_py(), pack_keys(keys[a:b]), *counts))
        return _table(out, ASKED)

    return ask


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as steps of equal width: one byte for the width, the first key, the steps."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    raw = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + keys[:1].astype("<u8").tobytes() + raw.tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    width = packed[0]
    raw = np.frombuffer(packed, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(packed[1:9], np.uint8)
    steps[1:, :width] = raw
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def _limits(n_shards: int) -> np.ndarray:
    """Equal key ranges: n_shards + 1 limits, the last one beyond all hashes."""
    step = (2**64 - 1) // n_shards
    return np.array([i * step for i in range(n_shards)] + [2**64 - 1], np.uint64)


def _answer(table: pa.Table) -> pa.Table:
    """Counts over all blocks of each asked key, per asking block and in its order."""
    asked = [table.column(c).to_pylist() for c in ("kind", "shard", "block", "keys", "train", "fold")]
    each = [unpack_keys(k) for k in asked[3]]
    distinct, at = np.unique(np.concatenate(each), return_inverse=True)
    sizes = np.cumsum([0] + [len(k) for k in each])
    del each
    train, fold = (
        np.bincount(
            at,
            np.concatenate([np.frombuffer(zlib.decompress(x), "<i4") for x in asked[i]]),
            len(distinct),
        ).astype("<i8")
        for i in (4, 5)
    )
    totals = (int(train.sum()), int((train - fold).sum()), int((train > 0).sum()))
    out = []
    for i, (a, b) in enumerate(zip(sizes[:-1], sizes[1:], strict=True)):
        mine = at[a:b]
        out.append(
            (asked[0][i], asked[1][i], asked[2][i])
            + tuple(zlib.compress(x[mine].tobytes(), 1) for x in (train, fold))
            + (totals if i == 0 else (0, 0, 0))
        )
    return _table(out, ANSWERED)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(),
          "boolean": pa.bool_()}


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.table({n: pa.array(c, _KINDS[k]) for c, (n, k) in zip(columns, fields, strict=True)})


def _counts(answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted(
        (shard, train, fold)
        for k, shard, train, fold in zip(
            *(answers.column(c).to_pylist() for c in ("kind", "shard", "train", "fold")), strict=True
        )
        if k == kind
    )
    return tuple(
        np.frombuffer(b"".join(zlib.decompress(r[i]) for r in rows), "<i8") for i in (1, 2)
    )


def buckets(context_counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 count)."""
    return np.where(context_counts > 0, np.frexp(np.maximum(context_counts, 1))[1], 0)


STATS = "bucket int, bin int, n long"


def _ratios(n_rest: int, n_types: int):
    def collect(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows or not answers.num_rows:
            return _table([], STATS)
        block = _read(docs)
        (c1, f1), (c2, f2) = _counts(answers, 1), _counts(answers, 2)
        single, pair = c1 - f1, (c2 - f2)[block.pair_at]
        context = single[block.context_at]
        p1 = (single[block.word_at] + 0.5) / (n_rest + 0.5 * (n_types + 1))
        ratio = pair / np.maximum(context, 1) / p1
        bins = np.full(len(ratio), -1)
        some = ratio > 0
        bins[some] = np.clip((np.log2(ratio[some]) + OCTAVES / 2) * BINS_PER_OCTAVE, 0, OCTAVES * BINS_PER_OCTAVE - 1)
        code = buckets(context) * (OCTAVES * BINS_PER_OCTAVE + 1) + bins + 1
        values, n = np.unique(code, return_counts=True)
        width = OCTAVES * BINS_PER_OCTAVE + 1
        return _table([(v // width, v % width - 1, m) for v, m in zip(values.tolist(), n.tolist(), strict=True)], STATS)

    return collect


def learn_weights(stats: list[tuple[int, int, int]], most_rounds: int = 200) -> tuple[float, ...]:
    """Weight of each bucket by expectation-maximisation over binned likelihood ratios."""
    weights = [0.0] * BUCKETS
    for bucket in range(1, BUCKETS):
        mine = [(b, n) for k, b, n in stats if k == bucket]
        if not mine:  # as the next rarer bucket
            weights[bucket] = weights[bucket - 1] if bucket > 1 else 0.1
            continue
        bins = np.array([b for b, _ in mine], float)
        n = np.array([m for _, m in mine], float)
        ratio = np.where(bins < 0, 0.0, 2.0 ** ((bins + 0.5) / BINS_PER_OCTAVE - OCTAVES / 2))
        g = 0.5
        for _ in range(most_rounds):
            g, last = float((n * g * ratio / (g * ratio + 1 - g)).sum() / n.sum()), g
            g = min(max(g, 1e-6), 1 - 1e-6)
            if abs(g - last) < 1e-9:
                break
        weights[bucket] = g
    return tuple(weights)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def _score(model: Model):
    weights = np.array(model.weights)

    def score(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], SCORES)
        block = _read(docs)
        (c1, _), (c2, _) = _counts(answers, 1), _counts(answers, 2)
        single = c1[block.word_at]
        context = c1[block.context_at]
        p1 = (single + 0.5) / (model.n_tokens + 0.5 * (model.n_types + 1))
        g = weights[buckets(context)]
        p = g * c2[block.pair_at] / np.maximum(context, 1) + (1 - g) * p1
        fold = block.folds
        held = [None if f < 0 else bool(f == TEST_FOLD) for f in fold.tolist()]
        return pa.table(
            {
                "doc_id": pa.array(_joined(docs, "ids"), pa.int64()),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": np.diff(block.bounds),
                "n_known": block.per_row((single > 0).astype(np.int64)),
                "train_tokens": np.full(len(fold), model.n_tokens, np.int64),
                "base_score": block.per_row(np.log10(p1)),
                "score": block.per_row(np.log10(p)),
            }
        )

    return score


def score_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, Model]:
    """Scores of all documents, and the model that gave them."""
    doc_id = F.col(id_column).cast("long").alias("doc_id")
    fold = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS))
    texts = docs.select(
        doc_id, F.col(text_column).alias("text"), F.coalesce(fold, F.lit(-1)).cast("int").alias("fold")
    )
    n_bytes, n_docs = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    n_blocks = (n_bytes or 0) // BLOCK_BYTES + 8
    n_shards = ((n_bytes or 0) // 4 + n_docs) // SHARD_TOKENS + 8
    # the fold that the weights are learned on has blocks of its own
    n_weight_blocks = n_blocks // FOLDS + 2
    hashed = F.xxhash64("doc_id", "text")
    block = F.when(
        F.col("fold") == WEIGHT_FOLD, F.pmod(hashed, F.lit(n_weight_blocks))
    ).otherwise(n_weight_blocks + F.pmod(hashed, F.lit(n_blocks)))
    placed = texts.select(block.alias("block"), "doc_id", "fold", "text")
    texts = placed.mapInArrow(_deal, DEALT)
    weight_texts = placed.filter(F.col("fold") == WEIGHT_FOLD).mapInArrow(_deal, DEALT)
    asked = texts.groupBy("block").applyInArrow(_ask(n_shards), ASKED)
    answers = stored(
        asked.groupBy("kind", "shard").applyInArrow(_answer, ANSWERED), "interpolation-counts"
    )
    totals = answers.filter("kind = 1").agg(F.sum("total"), F.sum("rest"), F.sum("types")).first()
    n_tokens, n_rest, n_types = (x or 0 for x in totals)
    replies = answers.select("block", "kind", "shard", "train", "fold")
    stats = (
        weight_texts.groupBy("block")
        .cogroup(replies.filter(F.col("block") < n_weight_blocks).groupBy("block"))
        .applyInArrow(_ratios(n_rest, n_types), STATS)
        .groupBy("bucket", "bin")
        .agg(F.sum("n").alias("n"))
    )
    weights = learn_weights([tuple(r) for r in stats.collect()])
    model = Model(n_tokens, n_types, n_rest, weights)
    scored = texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_score(model), SCORES)
    return scored, model
