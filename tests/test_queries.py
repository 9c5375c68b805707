"""Every named query against its expected answer on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import oracles
from harborlight import workload
from compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_answer():
    assert set(workload.all_queries()) == set(oracles.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    problems = compare(spark, con, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    problems = [p for p in problems if p != "expected answer is empty"]
    assert not problems, "\n".join(problems)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
