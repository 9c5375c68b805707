"""Suffix arrays and the removal of repeated strings against brute force."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from harborlight.llm import queries, suffixes


def answers(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_query(spark, sf_dir, texts):
    want = brute.repeated_bytes(texts)
    assert answers(queries.op4_suffix_dedup(spark, sf_dir)) == want
    assert sum(v[1] for v in want.values()) > 10_000


def made(seed: int) -> dict[int, str]:
    rng = random.Random(seed)
    phrase = lambda n: "".join(rng.choices("abé \0", k=n))
    passages = [phrase(n) for n in (30, 45, 50, 80, 200)]
    docs = {}
    for d in range(60):
        parts = [phrase(rng.randrange(60)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p))
            parts.insert(rng.randrange(3), p[cut:] if rng.random() < 0.3 else p)
        docs[d] = "".join(parts)
    docs |= {100: "a" * 500, 101: docs[1], 102: "ab" * 100, 103: None, 104: "", 105: passages[0] * 3}
    return docs


@pytest.mark.parametrize("segments", [2_000, 2])
def test_random_texts(spark, segments, monkeypatch):
    """With two segments an anchor, nearly all anchors are dealt into shards and merged."""
    monkeypatch.setattr(suffixes, "ANCHOR_SEGMENTS", segments)
    monkeypatch.setattr(suffixes, "GRAM", 8)
    monkeypatch.setattr(suffixes.anchor_runs, "__defaults__", (200, 8))
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 300)
    docs = made(segments)
    df = spark.createDataFrame(
        [(d, t, 1, "x") for d, t in docs.items()], "doc_id long, text string, start long, body string"
    )
    assert answers(suffixes.remove_repeats(df, 40)) == brute.repeated_bytes(docs, 40)


def test_kept_bytes(spark):
    text = "x" * 10 + "0123456789" * 21 + "y"
    df = spark.createDataFrame([(1, text), (2, "z" + text[10:-1])], "doc_id long, text string")
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove_repeats(df).collect()}
    assert got == {1: b"x" * 10 + b"y", 2: b"z"}


def test_odd(spark, odd_docs, no_docs, odd_texts):
    assert answers(suffixes.remove_repeats(odd_docs)) == brute.repeated_bytes(odd_texts)
    assert suffixes.remove_repeats(no_docs).count() == 0
    long = "".join(chr(97 + i % 23) for i in range(250))
    df = spark.createDataFrame([(1, long), (1, long), (None, "q" * 199)], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(df).collect())
    assert got == [(199, 0), (250, 250), (250, 250)]


def test_suffix_array_and_prefixes():
    rng = random.Random(4)
    segments = [bytes(rng.choices([0, 1, 255], k=rng.randrange(1, 60))) for _ in range(40)]
    segments += [segments[0], b"\x01" * 50]
    text, starts = suffixes._joined(segments)
    order = suffixes.suffix_array(text)
    ends = np.append(starts[1:], len(text))
    tail = lambda i: list(text[i : ends[np.searchsorted(starts, i, "right") - 1]])
    tails = [tail(i) for i in order]
    assert tails == sorted(tails)
    counts = np.array([len(s) + 1 for s in segments])
    shared = suffixes.common_prefixes(text, order, starts, counts, 20)
    for a, b in zip(order[:-1], order[1:], strict=True):
        x, y = tail(a)[:-1], tail(b)[:-1]
        n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert shared[b] == min(n, 20)


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 50, 1000).astype(np.uint64)
    for width in (1, 7, 999, 1000):
        want = [values[i : i + width].min() for i in range(1000 - width + 1)]
        assert list(suffixes.sliding_min(values, width)) == want
