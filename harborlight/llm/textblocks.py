"""Words, shingles and n-gram hashes of Arrow text columns, with numpy over whole batches.

A word's hash is a polynomial over random byte values modulo 2^64, taken from running
sums, then mixed; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
BYTE_VALUES = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: ASCII bytes that are neither letters nor digits
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: texts are handled in groups of about this many bytes, and no more than so many rows
GROUP_BYTES = 1 << 20
GROUP_ROWS = 2048


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        _powers = np.full(size, BASE, np.uint64)
        _inverses = np.full(size, BASE_INVERSE, np.uint64)
        _powers[0] = _inverses[0] = 1
        _powers, _inverses = np.multiply.accumulate(_powers), np.multiply.accumulate(_inverses)
    return _powers[:n], _inverses[:n]


def running_sums(data: np.ndarray) -> np.ndarray:
    """Sums before each byte, from which the hash of any stretch follows."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power_tables(len(data))[0], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverses = _power_tables(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * inverses[starts])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 bounds of its rows; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of ``batch`` of about GROUP_BYTES or GROUP_ROWS, with their text bytes and row bounds."""
    data, bounds = bytes_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(bounds, bounds[at] + GROUP_BYTES, "right")) - 1
        stop = min(max(stop, at + 1), at + GROUP_ROWS, batch.num_rows)
        part = bounds[at : stop + 1]
        yield batch.slice(at, stop - at), data[part[0] : part[-1]], part - part[0]
        at = stop


def word_hashes(
    data: np.ndarray, bounds: np.ndarray, fold: bool = True, breaks: np.ndarray = BLANK
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between ``breaks``, and the n + 1 bounds of the rows among them."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~breaks[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True  # a row's first byte begins a word even after another row's word
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | first))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | first))
    sums = running_sums(_FOLD[data] if fold else data)
    return stretch_hashes(sums, starts, ends), np.searchsorted(starts, bounds)


def shingle_sets(
    words: np.ndarray, bounds: np.ndarray, length: int = 3
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and their row bounds.

    A row with fewer words than ``length`` has all its words as one shingle.
    """
    counts = np.diff(bounds)
    made = np.where(counts >= length, counts - length + 1, (counts > 0).astype(counts.dtype))
    rows = np.repeat(np.arange(len(counts)), made)
    first = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(made)[:-1]]), made)
    at = first + np.arange(len(rows))
    h = np.zeros(len(rows), np.uint64)
    padded = np.concatenate([words, np.zeros(length, np.uint64)])
    ends = bounds[1:][rows]
    for k in range(length):
        term = np.where(at + k < ends, padded[at + k], np.uint64(k + 1))
        h = mixed(h * np.uint64(0xD1342543DE82EF95) + term)
    order = np.lexsort((h, rows))
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])  # rows are ascending already
    return h[new], np.searchsorted(rows[new], np.arange(len(counts) + 1))


def set_signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each row's set; equal sets have equal pairs."""
    out = []
    for salt in (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xA0761D6478BD642F)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(sets ^ salt), dtype=np.uint64)])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


SKETCH_BITS = 9


COARSE_BITS = 6


def set_sketches(
    sets: np.ndarray, bounds: np.ndarray
) -> tuple[list[bytes], list[np.ndarray | None]]:
    """How many members of each row's set fall into each of 512 ranges of hashes.

    Two sets share at most as many members of a range as the smaller count, so the sum of
    those is a bound that no pair of sets exceeds.  The second list has the same for 64
    ranges, in single bytes, and None for sets too large for that.
    """
    rows = len(bounds) - 1
    cells = np.repeat(np.arange(rows), np.diff(bounds)) << SKETCH_BITS
    cells |= (sets >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
    counts = np.bincount(cells, minlength=rows << SKETCH_BITS).reshape(rows, -1)
    fine = [c.astype("u1" if c.max(initial=0) < 256 else "<u4").tobytes() for c in counts]
    sums = counts.reshape(rows, 1 << COARSE_BITS, -1).sum(axis=2)
    return fine, [c.astype(np.int8) if c.max(initial=0) < 128 else None for c in sums]


def most_shared(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(v, "u1" if len(v) == 1 << SKETCH_BITS else "<u4") for v in (a, b))
    return int(np.minimum(x, y).sum(dtype=np.int64))
