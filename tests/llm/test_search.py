"""Ranked search against brute force over all documents."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from harborlight.llm import search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def ranked(docs, items, top=10):
    """Expected (item, rank, doc_id, score) rows; docs and items are lists of (id, text)."""
    found = [(d, terms(t)) for d, t in docs]
    found = [(d, t) for d, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = {}
    for _, t in found:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = set()
    for item, words in asked.items():
        scores = []
        for d, t in found:
            m = 10 + 90 * len(t) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * t.count(w) // (1000 * t.count(w) + 8 * m))
                for w in words
                if w in t
            )
            if score > 0:
                scores.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scores)[:top], 1):
            out.add((item, rank, d, -score))
    return out


def made(spark, docs, items, top=10):
    docs = spark.createDataFrame([(d, t, 7, "x") for d, t in docs], "doc_id long, text string, score long, rank string")
    items = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string")
    return {tuple(r) for r in search.ranked_search(docs, items, top).collect()}


def random_docs(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("sizes", [(40, 8, 4, 2), (250_000, 512, 64, 64), (200, 64, 1, 1)])
def test_ranks_like_brute_force(spark, monkeypatch, sizes):
    """Shards and intervals of any size give the same rows."""
    for name, value in zip(("SHARD_POSTINGS", "FIRST_DOCS", "LEAF_DOCS", "OPENED"), sizes, strict=True):
        monkeypatch.setattr(search, name, value)
    docs = random_docs(3, 300, 80)
    items = [(i, t) for i, t in random_docs(4, 12, 120)]
    assert made(spark, docs, items) == ranked(docs, items)
    assert made(spark, docs, items, 3) == ranked(docs, items, 3)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 20)
    docs, items = random_docs(5, 60, 40), random_docs(6, 20, 60)
    assert made(spark, docs, items) == ranked(docs, items)


def test_odd_texts(spark, odd_texts):
    docs = [*odd_texts.items(), (None, "one two"), (None, "one two"), (-5, "One Two"), (9, "one two")]
    items = [(1, "one TWO two"), (1, "three"), (2, None), (3, ""), (None, "tie é"), (4, "nowhere"), (5, "ß Σ́ x")]
    assert made(spark, docs, items) == ranked(docs, items)


def test_copies_are_ranked_by_id(spark):
    docs = [(i, "same text here") for i in range(500, 0, -1)] + [(1000 + i, f"other {i}") for i in range(600)]
    items = [(1, "same here")]
    got = made(spark, docs, items)
    assert got == ranked(docs, items)
    assert [d for _, _, d, _ in sorted(got)] == list(range(1, 11))


def test_empty_tables(spark):
    assert made(spark, [], [(1, "a")]) == set()
    assert made(spark, [(1, "a")], []) == set()
    assert made(spark, [(1, None)], [(1, "a")]) == set()


def test_norms_beyond_64_bits():
    lengths = np.array([1, 10**7, 3 * 10**9])
    n_docs, n_terms = 10**11, 5 * 10**13
    want = [10 + 90 * int(x) * n_docs // n_terms for x in lengths]
    assert search.length_norms(lengths, n_docs, n_terms).tolist() == want


def test_range_maxima():
    """Sparse tables give the greatest impact of any interval of any list."""
    rng = np.random.default_rng(2)
    n_docs, lists = 70, [np.sort(rng.choice(70, n, replace=False)) for n in (1, 2, 33, 70)]
    row = {
        "lengths": np.full(n_docs, 5),
        "terms": np.arange(4),
        "bounds": np.cumsum([0] + [len(x) for x in lists]),
        "docs": np.concatenate(lists),
        "counts": rng.integers(1, 50, sum(map(len, lists))),
    }
    asked = search.Queries([0], np.array([0, 4]), np.arange(4), np.array([5, 7, 9, 0]), 100, 5000, 10)
    shard = search.Shard(row, asked)
    low, high = np.array([(a, b) for a in range(70) for b in range(a + 1, 71)]).T
    values, at = shard.maxima(np.arange(4), low, high)
    for t, docs in enumerate(lists):
        impacts = shard.impacts[row["bounds"][t] : row["bounds"][t + 1]]
        for i, (a, b) in enumerate(zip(low, high, strict=True)):
            inside = impacts[(docs >= a) & (docs < b)]
            assert values[t, i] == max(inside, default=0)
            if len(inside):
                assert shard.impacts[at[t, i]] == values[t, i]
    assert shard.lists(np.arange(4), asked.weights).tolist() == [0, 1, 2]


def test_search_opens_few_intervals():
    """Documents far below the best are never scored."""
    n_docs = 20_000
    counts = np.ones(n_docs, np.int64)
    counts[:20] = 40
    row = {
        "lengths": np.full(n_docs, 50),
        "terms": np.array([0]),
        "bounds": np.array([0, n_docs]),
        "docs": np.arange(n_docs),
        "counts": counts,
    }
    asked = search.Queries([0], np.array([0, 1]), np.array([0]), np.array([1000]), n_docs, 50 * n_docs, 10)
    shard, best, seen = search.Shard(row, asked), search.Best(10), []
    best.begin(np.arange(n_docs))
    offer = best.offer
    best.offer = lambda docs, scores: (seen.append(len(docs)), offer(docs, scores))
    shard.search(np.array([0]), best)
    assert best.ids.tolist() == list(range(10))
    assert sum(seen) < 1000
