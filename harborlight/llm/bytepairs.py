"""Byte-level byte-pair encoding and decoding with batched merge rounds in numpy.

1. Texts are split at special tokens, then into words by the vocabulary's pattern.  Text in
   scripts whose character classes differ between Unicode versions is split by the
   tokenizers library's own splitter; the two agree everywhere else.
2. A task encodes each distinct word once.  The words of a batch that it does not know yet
   form one flat array of symbols, one symbol per byte at first.  Words end where no
   vocabulary entry spans two neighbouring bytes, too.
3. A round finds the rank of each pair of neighbours by binary search over the sorted pair
   keys, takes the lowest rank of each word, and merges that pair wherever it stands in the
   word, left to right.  Ranks are searched again only beside merged symbols; words
   without a known pair leave the array.
4. Words of many symbols would need many rounds over all of them: for those, positions wait
   by rank, and a round touches the positions of the lowest rank only.

A merge can only create pairs of higher rank, as every entry is made by one merge of two
entries made before; so both orders give what merging one pair at a time gives.

Decoding gathers the bytes of all ids of a batch in one indexing step.

Only rows move through a task: nothing is shuffled; the table of known words is bounded by
bytes and emptied when it is full, which changes no result.

Defined cases: null and empty texts have no ids, and no ids decode to the empty text; special
tokens in a text are their ids, as in the library; bytes that are not valid UTF-8 after
decoding become U+FFFD; equal rows have equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.llm.packing import byte_letters

#: fixed values: the splitting pattern of byte-level vocabularies of this kind
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters outside of these ranges may have another class in another Unicode version
SETTLED = "\x00-՗‐-⁤₠-₿　-ヿ一-龥가-힣！-～"
#: bytes of words, and of their ids, a task remembers
_KNOWN_BYTES = 48 << 20
#: texts are encoded in groups of about this many characters
_GROUP_CHARS = 1 << 20
#: words of more symbols are merged rank by rank
LONG_WORD = 256
_NONE = np.int32(2**31 - 1)


class Merges:
    """The vocabulary: bytes by id, and the sorted pair keys with rank and result of each."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            loaded = json.load(file)
        model, vocab = loaded["model"], loaded["model"]["vocab"]
        letters = byte_letters()
        raw_of = {chr(letters.get(b, b)): b for b in range(256)}
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        entries: list[bytes] = [b""] * size
        for text, number in vocab.items():
            entries[number] = bytes(raw_of[c] for c in text)
        for text, number in self.special.items():
            entries[number] = text.encode()
        self.first_ids = np.array([vocab[chr(letters.get(b, b))] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks = (left << 32 | right)[order], order.astype(np.int32)
        self.made = made  # by rank
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.spanned = np.zeros((256, 256), bool)
        inside = np.ones(len(self.data), bool)
        inside[self.starts[self.lengths > 0]] = False
        at = np.flatnonzero(inside)
        self.spanned[self.data[at - 1], self.data[at]] = True

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[found] == keys, self.ranks[found], _NONE)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) word as packed little-endian 32-bit numbers."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        # parts of words: nothing merges across their bounds
        cut = ~self.spanned[data[:-1], data[1:]]
        cut[ends[:-1] - 1] = True
        part = np.concatenate([[0], np.cumsum(cut)])
        symbols = self.first_ids[data]
        word = np.repeat(np.arange(len(words)), sizes)
        long = np.bincount(part)[part] > LONG_WORD
        done = []
        for kept, merge in ((~long, self._by_word), (long, self._by_rank)):
            if kept.any():
                at = np.flatnonzero(kept)
                done.append(merge(symbols[at], part[at], at))
        symbols, at = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(at, kind="stable")
        symbols, word = symbols[order].astype("<i4"), word[at[order]]
        bounds = 4 * np.searchsorted(word, np.arange(len(words) + 1))
        raw = symbols.tobytes()
        return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _by_word(self, symbols: np.ndarray, part: np.ndarray, at: np.ndarray):
        """(symbols, positions) after rounds that merge the lowest pair of every part."""
        out = []
        rank = self._neighbours(symbols, part)
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            sizes = np.diff(np.append(first, len(part)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), sizes)
            over = lowest == _NONE
            if over.any():
                out.append((symbols[over], at[over]))
                left = ~over
                symbols, part, at, rank, lowest = (x[left] for x in (symbols, part, at, rank, lowest))
                if not len(symbols):
                    break
            taken = _apart(np.flatnonzero(rank == lowest))
            symbols[taken] = self.made[rank[taken]]
            left = np.ones(len(symbols), bool)
            left[taken + 1] = False
            fresh = np.zeros(len(symbols), bool)
            fresh[taken] = True
            symbols, part, at, rank, fresh = (x[left] for x in (symbols, part, at, rank, fresh))
            near = np.flatnonzero(fresh | np.append(fresh[1:], False))
            rank[near] = self._ranks_at(symbols, part, near)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _neighbours(self, symbols: np.ndarray, part: np.ndarray) -> np.ndarray:
        return self._ranks_at(symbols, part, np.arange(len(symbols)))

    def _ranks_at(self, symbols: np.ndarray, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``; none at the end of a part."""
        after = np.minimum(at + 1, len(symbols) - 1)
        ranks = self.rank_of(symbols[at], symbols[after])
        return np.where((part[at] == part[after]) & (after > at), ranks, _NONE)

    def _by_rank(self, symbols: np.ndarray, part: np.ndarray, at: np.ndarray):
        """The same for long parts: positions wait by rank, neighbours are linked."""
        n = len(symbols)
        rank = self._neighbours(symbols, part)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(where: np.ndarray) -> None:
            where = where[rank[where] != _NONE]
            where = where[np.argsort(rank[where], kind="stable")]
            ranks = rank[where]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for group in np.split(where, cuts) if len(where) else ():
                key = int(rank[group[0]])
                if key not in waiting:
                    waiting[key] = []
                    heapq.heappush(queue, key)
                waiting[key].append(group)

        wait(np.arange(n))
        while queue:
            key = heapq.heappop(queue)
            where = np.unique(np.concatenate(waiting.pop(key)))
            where = where[alive[where] & (rank[where] == key)]
            if not len(where):
                continue
            # neighbours in a run of one symbol: every second one, from the left
            taken = where[_alternate(before[where] == np.concatenate([[-2], where[:-1]]))]
            gone = after[taken]
            symbols[taken] = self.made[key]
            alive[gone] = False
            after[taken] = after[gone]
            inner = after[taken] < n
            before[after[taken][inner]] = taken[inner]
            prior = before[taken]
            near = np.unique(np.concatenate([taken, prior[prior >= 0]]))
            following = np.minimum(after[near], n - 1)
            same = (after[near] < n) & (part[following] == part[near])
            rank[near] = np.where(same, self.rank_of(symbols[near], symbols[following]), _NONE)
            wait(near)
        return symbols[alive], at[alive]

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[shift + np.arange(total)]


def _alternate(follows: np.ndarray) -> np.ndarray:
    """Of runs of positions that each follow the one before, the first, third and so on."""
    index = np.arange(len(follows))
    start = np.maximum.accumulate(np.where(follows, 0, index))
    return (index - start) % 2 == 0


def _apart(where: np.ndarray) -> np.ndarray:
    """Positions without those that a merge at the position before uses up."""
    return where[_alternate(np.concatenate([[False], np.diff(where) == 1]))]


def _settled_splitter():
    """``PATTERN`` for settled text, with its classes spelled out: the plain module is twice as quick."""
    import regex

    chars = "".join(regex.findall(f"[{SETTLED}]", "".join(map(chr, range(0x10000)))))
    classes = {}
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        runs = regex.findall(f"{kind}+", chars)
        numbers = [ord(c) for run in runs for c in run]
        cuts = [i for i in range(1, len(numbers)) if numbers[i] != numbers[i - 1] + 1]
        spans = [(numbers[i], numbers[j - 1]) for i, j in zip([0, *cuts], [*cuts, len(numbers)], strict=True)]
        classes[kind] = "".join(f"\\u{x:04x}-\\u{y:04x}" for x, y in spans)
    letter, digit, space = classes.values()
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    ).findall


class Encoder:
    """Ids of texts; words met before are looked up."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        self.known: dict[str, bytes] = {}
        self.held = 0
        self.words = _settled_splitter()
        self.unsettled = regex.compile(f"[^{SETTLED}]").search
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        special = sorted(self.merges.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, special))) if special else None

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not self.unsettled(text):
            return self.words(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def split(self, text: str) -> list[str]:
        """Words and special tokens."""
        if not self.specials or not any(s in text for s in self.merges.special):
            return self._plain(text)
        words, at = [], 0
        for found in self.specials.finditer(text):
            words += self._plain(text[at : found.start()])
            words.append(found[0])
            at = found.end()
        return words + self._plain(text[at:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        split = [self.split(t) for t in texts]
        if self.held > _KNOWN_BYTES:
            self.known, self.held = {}, 0
        known = self.known
        known.update({s: np.int32(i).tobytes() for s, i in self.merges.special.items()})
        new = list(set().union(*split).difference(known))
        if new:
            packed = self.merges.merged([w.encode() for w in new])
            known.update(zip(new, packed, strict=True))
            self.held += sum(map(len, new)) + sum(map(len, packed)) + 150 * len(new)
        return [b"".join(map(known.__getitem__, words)) for words in split]


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts, about ``_GROUP_CHARS`` characters each."""
    texts, first, held = [], 0, 0
    for i, text in enumerate(batch.column(column)):
        texts.append(text.as_py() or "")
        held += len(texts[-1])
        if held >= _GROUP_CHARS:
            yield batch.slice(first, i + 1 - first), texts
            texts, first, held = [], i + 1, 0
    if texts:
        yield batch.slice(first), texts


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and ids (array of int) per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for part, texts in _groups(batch, 1):
                packed = encoder.encode(texts)
                bounds = np.cumsum([0] + [len(p) // 4 for p in packed]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(bounds), values)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    chosen = docs.select(F.col(id_column).cast("long"), F.col(text_column))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the decoded text of each row of ``encoded``; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(path)
        for batch in batches:
            column = batch.column(1)
            texts = []
            for ids in column:
                numbers = ids.values.to_numpy() if ids.is_valid else np.empty(0, np.int32)
                texts.append(merges.decoded(numbers).tobytes().decode("utf-8", "replace"))
            arrays = [batch.column(0), column, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    chosen = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return chosen.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
