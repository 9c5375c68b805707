"""Benchmark decontamination against brute force."""

from __future__ import annotations

import random

import brute

from harborlight.llm import decontaminate, queries


def answers(df):
    return {
        r.doc_id: (r.n_words, r.n_hit, r.n_items, brute.sha(",".join(r["items"])), r.contaminated)
        for r in df.collect()
    }


def test_query(spark, sf_dir, texts):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = brute.decontaminate(texts, {r.item_id: r.text for r in items})
    got = queries.op9_decontamination(spark, sf_dir).collect()
    assert {
        r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got
    } == want
    assert any(v[4] for v in want.values())


def test_random_texts(spark):
    """A small vocabulary, so that windows overlap, repeat and differ by one word."""
    rng = random.Random(5)
    vocabulary = "a b c d e É é 1 2".split()
    items = {i: " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 5, 13, 20]))) for i in range(12)}
    items |= {20: None, 21: "", 22: "...", 23: items[3], 24: "never seen words"}
    docs = {}
    for d in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if d % 3 == 0:
            words[5:5] = items[rng.randrange(12)].upper().split()
        docs[d] = rng.choice([" ", "-", "\n"]).join(words)
    docs |= {70: None, 71: "", 72: docs[0]}
    df = spark.createDataFrame(
        [(d, t, "x", 1) for d, t in docs.items()], "doc_id long, text string, word string, key int"
    )
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute.decontaminate(docs, items)
    assert answers(decontaminate.contamination(df, bench)) == want
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, v in want.items() if not v[4]}


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "a b c"), (None, "tie tie")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(odd_docs, items).collect()}
    assert len(got) == 14
    assert got[10].n_hit == 8 and got[11].n_hit == 0 and got[0].n_words == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(odd_docs, items.limit(0)).collect())
    assert decontaminate.contamination(no_docs, items).count() == 0


def test_repeated_rows_and_items_without_id(spark):
    docs = spark.createDataFrame(
        [(1, "x tie tie y"), (1, "x tie tie y"), (1, "clean"), (None, "tie tie")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(None, "tie tie"), (3, "tie tie")], "item_id long, text string")
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_hit, r["items"])
        for r in decontaminate.contamination(docs, items).collect()
    )
    assert got == [(0, 2, 2, ["3"]), (1, 1, 0, []), (1, 4, 2, ["3"]), (1, 4, 2, ["3"])]


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta"
    docs = {1: "x " + item, 2: item.replace("gamma", "gamma new words"), 3: "alpha x y z q w e r t u zeta"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_near) for r in decontaminate.contamination(df, bench).collect()}
    assert got[1] == (6, 1) and got[2][0] == 0 and got[3][0] == 0
