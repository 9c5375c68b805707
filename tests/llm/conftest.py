from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r[0]: r[1] for r in rows}


#: null, empty and blank texts, long words, control characters, ties and copies
ODD_TEXTS = [
    None, "", " ", "\n\n\t", "a", "A a A", "x" * 3000, "é" * 700, "\x00\x1f\x85 b",
    "one two three four five six seven eight nine ten", "tie tie tie tie tie tie tie tie",
    "one two three four five six seven eight nine ten", "Σ\u0301 o\u0301 ß İ ſ \U0001f600 z",
    " ".join(f"w{i}" for i in range(5000)),
]


@pytest.fixture(scope="session")
def odd_texts():
    return dict(enumerate(ODD_TEXTS))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd texts with extra columns whose names clash with results of the operators."""
    rows = [(i, t, "x", i, None, "l", "k") for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, length string, start long, n_words long, labels string,"
        " shard string",
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
