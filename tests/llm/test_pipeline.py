"""The pipeline stage by stage against brute force, and as a whole."""

from __future__ import annotations

import brute
import pytest
from test_rowwise import check_packing

import __spark_entry__
import corpus_pipeline


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def as_texts(df):
    return {r.doc_id: r.text for r in df.collect()}


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_stages_filter_what_they_should(spark, sf_dir, docs):
    good = stage("quality rules")(spark, docs, sf_dir)
    texts = as_texts(good)
    everything = as_texts(docs)
    assert not any(brute.quality(t)[5] for t in texts.values())
    # what goes is short, repetitive, or full of symbols or of words that no language has
    for d in set(everything) - set(texts):
        n, _, symbols, _, _, failed = brute.quality(everything[d])
        stops = sum(w in brute_stop_words() for w in brute.blank_words(everything[d]))
        assert failed or symbols > 0.3 * n or stops < n // 60 or brute.quality(everything[d])[3] > 0

    one = stage("near duplicates")(spark, good, sf_dir)
    groups = brute.near_components(texts, 5, 80)
    assert set(as_texts(one)) == {c for _, c in groups.values()}

    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    clean = stage("benchmark decontamination")(spark, one, sf_dir)
    found = brute.decontaminate(as_texts(one), items)
    assert set(as_texts(clean)) == {d for d, v in found.items() if not v[4]}

    redacted = stage("personal data")(spark, clean, sf_dir)
    before, after = as_texts(clean), as_texts(redacted)
    assert set(before) == set(after)
    for d, text in before.items():
        assert (after[d] == text) == (not any(brute.personal(text).values())), d
        assert not any(brute.personal(after[d]).values())
    for kept in (good, one, clean, redacted):
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes


def brute_stop_words():
    from harborlight.llm.quality import STOP_WORDS

    return set(STOP_WORDS)


def test_run(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.count() > 0 and packed.filter("octet_length(ids) <> 4 * length").count() == 0
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run


def test_packing_stage(spark, sf_dir, odd_docs, odd_texts):
    check_packing(stage("packing")(spark, odd_docs, sf_dir), odd_texts)


def test_empty_documents(spark, sf_dir, docs):
    for _, run in corpus_pipeline.STAGES:
        assert run(spark, docs.limit(0), sf_dir).count() == 0
