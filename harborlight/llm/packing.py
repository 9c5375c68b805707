"""Packing of tokenized documents into fixed windows by best fit, longest first.

1. Tokenize: a document becomes its token ids and one end id.  The vocabulary's
   normalizer and splitter never join characters across ASCII blanks, so ids are made
   once per distinct blank-separated chunk, and for plain words once per distinct word.
2. Cut: documents longer than a window are first cut into full windows, which are
   sequences of their own; at most one shorter rest per document is left.
3. Pack: the rests are dealt into shards by a hash of the document; inside a shard they
   are taken longest first, and a segment tree over remaining capacities finds the
   tightest open window in a number of steps that depends on the window size only.

Shards hold about ``shard_pieces`` rests, so one task's memory is bounded and at most
a few windows per shard stay partly filled.  Sequence ids are 64-bit: shard in the
upper half, number in the shard in the lower.

Defined cases: null and empty texts are one end id; equal rows are separate documents;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
_CACHE_CHUNKS = 400_000
_CACHE_BYTES = 32 << 20
_DOCS_AT_ONCE = 200


#: a Latin word in its composed form, and ASCII marks (no apostrophe) behind it: the
#: splitter cuts between the two, and lower-casing and normalizing the word is plain
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write bytes without a printable form as letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


class _Table(dict):
    """Ids by chunk, made when a chunk is first asked for; ``held`` counts the bytes."""

    def __init__(self, make: Callable[[bytes], bytes]) -> None:
        self.make, self.held = make, 0

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self[chunk] = self.make(chunk)
        self.held += len(chunk) + len(ids)
        return ids


class ChunkTokenizer:
    """Token ids of texts through bounded tables of blank-separated chunks and their words."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.chunks = _Table(self._chunk)
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            raw = word.encode().decode("latin-1").translate(self.letters)
            found = _packed([t.id for t in self.tokenizer.model.tokenize(raw)])
            self.words[word] = found
        return found

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return self._whole(text)
        ids = self._word(plain[1].lower())
        if plain[2]:
            if plain[2] not in self.words:
                self.words[plain[2]] = self._whole(plain[2])
            ids += self.words[plain[2]]
        return ids

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as packed little-endian 32-bit numbers, in order."""
        for text in texts:
            split = text.encode().split()  # bytes split at ASCII blanks only
            if len(self.chunks) > _CACHE_CHUNKS or self.chunks.held > _CACHE_BYTES:
                self.chunks.clear()
                self.chunks.held = 0
                self.words.clear()
            yield b"".join(map(self.chunks.__getitem__, split))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    end_id: int = 1,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of at most ``window`` ids that make up each document; ids are little-endian."""
    schema = _arrow(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer(tokenizer_path)
        end = _packed([end_id])
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCS_AT_ONCE):
                part = batch.slice(at, _DOCS_AT_ONCE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = []
                for doc_id, body in zip(
                    part.column(0).to_pylist(), tokenizer.encode(texts), strict=True
                ):
                    ids = body + end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        raw = ids[4 * start : 4 * (start + window)]
                        kept = raw if with_ids else None
                        rows.append((doc_id, start, len(raw) // 4, zlib.crc32(raw), n, kept))
                yield _batch(rows, schema)

    return docs.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(cut, PIECES)


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree over the capacities."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)  # open windows below each node
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.filled[node] += by
            node >>= 1

    def put(self, capacity: int, window_id: int) -> None:
        self.windows[capacity].append(window_id)
        self._change(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """(capacity, window) of the least capacity that holds ``length``; it is taken out."""
        node = length + self.leaves
        if not self.filled[node]:
            while node & 1 or not self.filled[node + 1]:  # up, until a right sibling has some
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.filled[node]:
                    node += 1
        capacity = node - self.leaves
        self._change(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each piece; lengths must be in decreasing order."""
    tree, numbers, offsets, used = OpenWindows(window), [], [], 0
    for length in lengths:
        found = tree.tightest(length)
        if found is None:
            capacity, number = window, used
            used += 1
        else:
            capacity, number = found
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            tree.put(capacity - length, number)
    return numbers, offsets


def most_pieces(docs: DataFrame, window: int = 2048, text_column: str = "text") -> int:
    """About how many pieces ``docs`` can have: an id stands for a byte at least."""
    n_bytes = F.coalesce(F.octet_length(F.col(text_column)), F.lit(0))
    n = docs.agg(F.sum(F.floor(n_bytes / window) + 1)).first()[0]
    return int(n or 0)


def pack(pieces: DataFrame, n_pieces: int, window: int = 2048, shard_pieces: int = 50_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``n_pieces`` only sets the number of shards; it need not be exact.  Shards are drawn
    per row, so that rows of one id (or none) are spread as well; full windows are
    sequences as they are and skip the tree.
    """
    n_shards = max(1, -(-n_pieces // shard_pieces))
    columns = pieces.columns
    shard = F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(n_shards))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    schema += ", sequence_id long, offset long"

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
        )
        lengths = table.column("length").to_numpy()
        full = int(np.count_nonzero(lengths == window))  # they stand first
        numbers, offsets = best_fit(lengths[full:].tolist(), window)
        first = table.column("shard")[0].as_py() << 32 if table.num_rows else 0
        ids = first + np.concatenate([np.arange(full), np.array(numbers, "int64") + full])
        offsets = np.concatenate([np.zeros(full, "int64"), np.array(offsets, "int64")])
        return (
            table.select(columns)
            .append_column("sequence_id", pa.array(ids))
            .append_column("offset", pa.array(offsets))
        )

    return pieces.withColumn("shard", shard).groupBy("shard").applyInArrow(fill, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
