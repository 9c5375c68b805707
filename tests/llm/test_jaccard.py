"""The set-similarity join against a comparison of every pair."""

from __future__ import annotations

import random

import brute
import pytest

from harborlight.llm import jaccard, queries
from harborlight.llm.components import components


def answers(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query(spark, sf_dir, texts):
    want = brute.near_components(texts)
    assert answers(queries.op5_jaccard_join(spark, sf_dir)) == want
    assert len({c for _, c in want.values()}) < len(want)


def made(seed: int) -> dict[int, str]:
    """Chains of edits, copies, a passage shared by most, and sizes around the bound."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = [word() for _ in range(40)]
    docs, last = {}, None
    for d in range(150):
        kind = rng.randrange(5)
        if last and kind < 3:
            words = list(last)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(rng.choice([1, 2, 3, 20, 60, 120]))]
            if kind == 3:
                words[1:1] = passage
        docs[d] = " ".join(words)
        last = words if rng.random() < 0.8 else last
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed, monkeypatch):
    docs = made(seed)
    df = spark.createDataFrame(
        [(d, t, 1, "x") for d, t in docs.items()], "doc_id long, text string, n long, id string"
    )
    monkeypatch.setattr(jaccard, "CHUNK", 1000)
    want = brute.near_components(docs)
    assert answers(jaccard.near_duplicates(df)) == want
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_pairs_far_from_their_leader(spark):
    """Near copies that are linked with each other but not with the leader of their lists."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    docs = {}
    for d in range(40):
        words = list(base)
        for _ in range(rng.choice([2, 4, 6, 8])):
            words[rng.randrange(300)] = f"e{rng.randrange(30)}"
        docs[d] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert answers(jaccard.near_duplicates(df)) == brute.near_components(docs)


def test_near_copies_meet_at_the_text_they_were_made_from(spark, monkeypatch):
    """Copies with some edits each are far from each other; few of their pairs may be compared."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    docs = {500: " ".join(base)}
    for d in range(200):
        words = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 4)):
            words[at] = f"e{d}x{at}"
        docs[d] = " ".join(words)
    compared = {}

    def counted(df, purpose, store=jaccard.stored):
        rows = store(df, purpose)
        compared[purpose] = compared.get(purpose, 0) + rows.count()
        return rows

    monkeypatch.setattr(jaccard, "stored", counted)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    found = {r.component_id for r in jaccard.near_duplicates(df, 5, 80).collect()}
    assert found == {0}
    assert compared["jaccard-drawn"] + compared.get("jaccard-open", 0) < len(docs)


def test_lists_hold_only_sets_that_fit_by_size(spark, monkeypatch):
    """Texts that share shingles but differ in size can't be linked; their entries aren't stored."""
    words = [f"w{i}" for i in range(2000)]
    docs = {d: " ".join(words[: int(20 * 1.25**d)]) for d in range(20)}
    lists = []

    def counted(df, purpose, store=jaccard.stored):
        rows = store(df, purpose)
        if purpose == "jaccard-lists":
            lists.append(rows.select("id").distinct().count())
        return rows

    monkeypatch.setattr(jaccard, "stored", counted)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert answers(jaccard.near_duplicates(df)) == brute.near_components(docs)
    docs[50] = docs[19] + " end"
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = brute.near_components(docs)
    assert answers(jaccard.near_duplicates(df)) == want and want[50][1] == 19
    assert lists == [0, 2]


def test_no_pair_of_a_list_is_lost(spark):
    """Entries left are those of at least one pair that the size bound and short prefixes admit."""
    rng = random.Random(5)
    sets = {k: rng.randrange(20, 60) for k in range(300)}
    rows = {(t, k) for t in range(60) for k in rng.sample(range(300), rng.choice([1, 2, 3, 8, 40]))}
    entries = [(t, k, sets[k], rng.randrange(8)) for t, k in sorted(rows)]
    entries = [(*e, e[3] < 4) for e in entries]
    copies = rng.choices(entries, k=80)
    df = spark.createDataFrame(entries + copies, "token long, k1 long, n long, at long, is_short boolean")
    for percent in (80, 90):
        got = [tuple(r) for r in jaccard._partnered(df, percent).filter("may_link").collect()]
        want, size = set(), {}
        for x in entries:
            size[x[0]] = size.get(x[0], 0) + 1
            for y in entries:
                if x[0] == y[0] and x[1] != y[1] and y[2] <= x[2] and 100 * y[2] >= percent * x[2] and y[4]:
                    want |= {x, y}
        assert sorted(got) == sorted((*e, size[e[0]], True) for e in want)
        assert len(want) < len(entries)


def test_odd(spark, odd_docs, no_docs, odd_texts):
    assert answers(jaccard.near_duplicates(odd_docs)) == brute.near_components(odd_texts)
    assert jaccard.near_duplicates(no_docs).count() == 0
    df = spark.createDataFrame(
        [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (4, "A b c d"), (7, None)],
        "doc_id long, text string",
    )
    got = sorted(map(tuple, jaccard.near_duplicates(df).select("doc_id", "component_id").collect()), key=str)
    assert got == [(4, 4), (5, 4), (5, 4), (7, 7), (None, None)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)]
    edges += [(None, 3), (4, None), (5, 5), (1000, 1001), (1000, 1001)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
