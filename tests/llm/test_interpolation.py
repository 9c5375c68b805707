"""Deleted interpolation against counts made in plain Python."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import brute
import pytest

from harborlight.llm import interpolation, queries


def tokens(text):
    return [*brute.BLANK_WORD.findall(brute.lower(text or "")), None]


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


def expected(texts, model):
    """doc_id → n_tokens, n_known, N, base_score, score under the model's weights."""
    single, pair = Counter(), Counter()
    for d, t in texts.items():
        if remainder(d) != 1:
            words = tokens(t)
            single.update(words)
            pair.update(zip(["<s>", *words[:-1]], words, strict=True))
    n, v = sum(single.values()), len(single)
    assert (model.n_tokens, model.n_types) == (n, v)
    out = {}
    for d, t in texts.items():
        words, base, score = tokens(t), 0.0, 0.0
        for before, w in zip(["<s>", *words[:-1]], words, strict=True):
            p1 = (single[w] + 0.5) / (n + 0.5 * (v + 1))
            context = single[None] if before == "<s>" else single[before]
            g = model.weights[context.bit_length()]
            base += math.log10(p1)
            score += math.log10(g * pair[before, w] / max(context, 1) + (1 - g) * p1)
        out[d] = (remainder(d) == 1, len(words), sum(single[w] > 0 for w in words), n, base, score)
    return out


def check(scored, model, texts):
    want = expected(texts, model)
    rows = scored.collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert tuple(r)[1:5] == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9)
        assert r.score == pytest.approx(want[r.doc_id][5], rel=1e-9)
    return rows


def test_query(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored, model = interpolation.score_texts(docs)
    rows = check(scored, model, texts)
    assert queries.op2_lm_score(spark, sf_dir).columns == list(rows[0].asDict())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_blocks(spark, odd_docs, odd_texts, no_docs, monkeypatch):
    monkeypatch.setattr(interpolation, "BLOCK_BYTES", 2_000)
    monkeypatch.setattr(interpolation, "SHARD_TOKENS", 500)
    check(*interpolation.score_texts(odd_docs), odd_texts)
    assert interpolation.score_texts(no_docs)[0].count() == 0


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(None, "a b"), (0, "a b"), (0, "a b"), (2, "b a"), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = interpolation.score_texts(df)[0].collect()
    assert len(got) == 5
    learned = sum(len(tokens(t)) for d, t in rows if d is not None and remainder(d) != 1)
    assert {r.train_tokens for r in got} == {learned}
    assert [r.held_out for r in got if r.doc_id is None] == [None]


def test_weights_are_learned():
    width = interpolation.BINS_PER_OCTAVE
    middle = interpolation.OCTAVES // 2 * width
    # ratio 16 in 80 of 100 cases, 0 in the rest: the likelihood's maximum is known
    weights = interpolation.learn_weights([(3, middle + 4 * width, 80), (3, -1, 20)])
    ratio = 2 ** (4 + 0.5 / width)
    best = max((80 * math.log(g * ratio + 1 - g) + 20 * math.log(1 - g), g) for g in [i / 10000 for i in range(1, 10000)])
    assert weights[3] == pytest.approx(best[1], abs=2e-4)
    assert weights[4] == weights[3] and weights[0] == 0


def test_keys_travel_packed():
    import numpy as np

    rng = np.random.default_rng(0)
    for high in (5, 2**20, 2**64 - 1):
        keys = np.unique(rng.integers(0, high, 200, dtype=np.uint64))
        assert (interpolation.unpack_keys(interpolation.pack_keys(keys)) == keys).all()
    one = np.array([2**64 - 1], np.uint64)
    assert (interpolation.unpack_keys(interpolation.pack_keys(one)) == one).all()
