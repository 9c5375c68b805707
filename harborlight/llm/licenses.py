"""License scan: exact set-similarity join between license templates and text blocks.

A document is cut into overlapping blocks of words, twice as long as the longest
template and half a block apart, so that any stretch as long as a template lies inside
one block.  A block meets a template when it holds at least ``threshold`` of the
template's distinct words.

Tokens are ordered by their frequency in the whole corpus, rarest first.  A block that
meets a template must hold one of the template's first ``n - need + 1`` tokens (prefix
filter), must have at least ``need`` distinct words (length filter), and from the
position of the first shared prefix token the remaining tokens must still suffice
(positional filter); what is left is verified word by word.  The templates are the
stated query set; the documents are only streamed, so no row is ever shuffled except
the token counts, which are bounded by the templates' vocabulary.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows
are scanned one by one; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: bytes of words to themselves, A-Z to a-z, all other ASCII to a space
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

PHRASES = {
    # fixed values: phrase and label
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

TEMPLATES = {
    # common notices, by label
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "apache-notice": "licensed under the apache license version 2 0",
    "mit-notice": "released under the mit license",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "all-rights-reserved": "all rights reserved",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of"
    " this software and associated documentation files to deal in the software without restriction",
    "bsd-conditions": "redistribution and use in source and binary forms with or without"
    " modification are permitted provided that the following conditions are met",
    "apache-header": "you may not use this file except in compliance with the license you may"
    " obtain a copy of the license at",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any"
    " warranty without even the implied warranty of merchantability",
    "cc-by-sa": "this work is licensed under a creative commons attribution sharealike license",
}


def split_words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass
class Template:
    label: str
    words: list[bytes]
    need: int
    is_phrase: bool
    prefix: list[bytes] = field(default_factory=list)
    ordered: list[bytes] = field(default_factory=list)


def _build(phrases: dict[str, str], templates: dict[str, str], threshold: float) -> list[Template]:
    made = []
    for text, label in phrases.items():
        words = split_words(text)
        made.append(Template(label, words, len(set(words)), True))
    for label, text in templates.items():
        words = split_words(text)
        need = -(-len(set(words)) * round(threshold * 1000) // 1000)
        made.append(Template(label, words, need, False))
    return made


def _order(templates: list[Template], counts: dict[bytes, int]) -> None:
    """Sort each template's tokens by corpus frequency, then by value, and cut its prefix."""
    for t in templates:
        t.ordered = sorted(set(t.words), key=lambda w: (counts.get(w, 0), w))
        t.prefix = t.ordered[: len(t.ordered) - t.need + 1]


def token_counts(docs: DataFrame, text_column: str, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Occurrences of each template token in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    words = split_words(text)
                    if not vocabulary.isdisjoint(words):
                        total.update(w for w in words if w in vocabulary)
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())}
        )

    counted = docs.select(F.col(text_column)).mapInArrow(count, "word binary, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


class _Scanner:
    """Prefix index over the templates, applied to one document at a time."""

    def __init__(self, templates: list[Template]) -> None:
        self.templates = templates
        self.stride = max(len(t.words) for t in templates)
        self.index: dict[bytes, list[tuple[Template, int]]] = {}
        for t in templates:
            for position, word in enumerate(t.prefix):
                self.index.setdefault(word, []).append((t, position))
        self.keys = set(self.index)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[str, int]], dict[str, float]]:
        """Places of phrases as (label, first word), and the best containment per template."""
        places: set[tuple[str, int]] = set()
        scores: dict[str, float] = {}
        if self.keys.isdisjoint(words):
            return [], scores
        seen = [i for i, w in enumerate(words) if w in self.keys]
        blocks: dict[int, set[bytes]] = {}
        for i in seen:
            k = i // self.stride
            for block in (k - 1, k) if k else (k,):
                blocks.setdefault(block, set()).add(words[i])
        for block, hits in blocks.items():
            start = block * self.stride
            inside = words[start : start + 2 * self.stride]
            tokens = set(inside)
            first: dict[int, tuple[Template, int]] = {}
            for word in hits:
                for t, position in self.index[word]:
                    if position < first.get(id(t), (t, len(t.ordered)))[1]:
                        first[id(t)] = (t, position)
            for t, position in first.values():
                if len(tokens) < t.need or len(t.ordered) - position < t.need:
                    continue
                shared = sum(w in tokens for w in t.ordered[position:])
                if shared < t.need:
                    continue
                if t.is_phrase:
                    places.update((t.label, start + at) for at in _places(inside, t.words))
                scores[t.label] = max(scores.get(t.label, 0.0), shared / len(t.ordered))
        return sorted(places, key=lambda x: (x[1], x[0])), scores


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    found, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return found
        if words[at : at + len(phrase)] == phrase:
            found.append(at)


SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: exact phrase places, labels and the best containment."""
    built = _build(phrases, templates, threshold)
    labels = set(templates)
    vocabulary = {w for t in built for w in t.words}
    _order(built, token_counts(docs, text_column, vocabulary))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(built)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = split_words(text) if text else []
                places, scores = scanner.scan(words)
                base = sorted({label for label, _ in places})
                met = sorted(set(base) | {x for x in scores if x in labels})
                # a phrase's words may all lie in a block without standing together
                own = [v for k, v in scores.items() if k in labels] + [1.0] * bool(places)
                rows.append(
                    (
                        doc_id, len(words), len(places), places[0][1] if places else None,
                        places[-1][1] if places else None, ",".join(base), ",".join(met),
                        max(own, default=0.0),
                    )
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA
            )

    rows = docs.select(F.col(id_column).cast("long"), F.col(text_column))
    return rows.mapInArrow(apply, SCANNED)


_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)
