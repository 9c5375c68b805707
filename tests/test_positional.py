"""Positional limits against brute force, with one group holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harborlight.operators import positional
from harborlight.operators.positional import bytes_per_group, head_per_group, tail_per_group
from helpers import plan

GROUPS = ["hot", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for line in rng.sample(range(0, 400_000), 3000):
        group = "hot" if rng.random() < 0.7 else rng.choice(GROUPS)
        out.append((group, f"f{line // 150_000}", line, rng.randint(1, 40)))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, f string, n long, size int").repartition(6).cache()


def brute(rows, keep):
    """Apply ``keep(list of rows in order)`` to every group."""
    kept = set()
    for group in GROUPS:
        ordered = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2]))
        kept |= {r[:3] for r in keep(ordered)}
    return kept


def collected(df):
    assert df.columns == ["g", "f", "n", "size"]
    found = [tuple(r)[:3] for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("small_limit", [0, 1000])  # 0: always by running totals
@pytest.mark.parametrize("n", [1, 7, 600, 5000])
def test_head_and_tail(frame, rows, n, small_limit):
    head = head_per_group(frame, ["g"], ["f", "n"], n, small_limit)
    assert collected(head) == brute(rows, lambda g: g[:n])
    tail = tail_per_group(frame, ["g"], ["f", "n"], n, small_limit)
    assert collected(tail) == brute(rows, lambda g: g[-n:])


@pytest.mark.parametrize("budget", [0, 1, 55, 3000, 10**9])
@pytest.mark.parametrize("bound", [None, 500])
def test_byte_budget(frame, rows, budget, bound):
    def keep(group):
        total, out = 0, []
        for r in group:
            total += r[3]
            if total > budget:
                break
            out.append(r)
        return out

    got = bytes_per_group(frame, ["g"], ["f", "n"], F.col("size"), budget, bound)
    assert collected(got) == brute(rows, keep)


def test_zero_rows(frame):
    assert tail_per_group(frame, ["g"], ["f", "n"], 0).count() == 0


def test_huge_positions_keep_their_order(spark):
    base = 1 << 60
    df = spark.createDataFrame([("g", base + i, 1) for i in range(10)], "g string, n long, size int")
    got = tail_per_group(df, ["g"], ["n"], 3, small_limit=0)
    assert sorted(r.n - base for r in got.collect()) == [7, 8, 9]


def test_small_limits_are_group_limits(frame):
    text = plan(head_per_group(frame, ["g"], ["f", "n"], 5))
    assert text.count("WindowGroupLimit") == 4  # partial and final, per bucket and per group


def test_large_limits_never_rank_a_whole_group(frame):
    text = plan(head_per_group(frame, ["g"], ["f", "n"], positional.SMALL_LIMIT + 1))
    ranked = [part for part in text.split("Window [")[1:] if "_chunk" not in part.split("\n")[0]]
    assert not ranked


def test_missing_keys_are_a_group(spark):
    """Both ways keep rows whose key or leading order column is NULL."""
    rows = [(None if i % 2 else "a", None if i % 3 else "f", i, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, f string, n long, size int")
    for limit in (head_per_group, tail_per_group):
        for n in (10, 1400):
            by_rank = limit(df, ["g"], ["f", "n"], n, small_limit=10_000).collect()
            by_sums = limit(df, ["g"], ["f", "n"], n, small_limit=0).collect()
            assert len(by_rank) == 2 * n and sorted(map(str, by_rank)) == sorted(map(str, by_sums))
    budgeted = bytes_per_group(df, ["g"], ["f", "n"], F.col("size"), 700)
    assert budgeted.count() == 1400
    bounded = bytes_per_group(df, ["g"], ["f", "n"], F.col("size"), 700, group_rows=1000)
    assert sorted(map(str, bounded.collect())) == sorted(map(str, budgeted.collect()))


@pytest.mark.parametrize("limit", [1, 7, 250, 999, 1000, 5000])
def test_long_prefix_of_an_order(spark, monkeypatch, limit):
    """Cut out of ranges: the same rows in the same order, no exchange into one partition of them all."""
    from harborlight.operators import filters

    monkeypatch.setattr(filters, "HEAP_ROWS", 0)
    rows = spark.range(1000).select(
        (F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("g"), F.lit("x").alias("w")
    )
    got = [tuple(r) for r in filters.first_rows(rows, ["g", "k"], limit).collect()]
    assert got == [tuple(r) for r in rows.orderBy("g", "k").limit(limit).collect()]


def test_prefix_ranks_only_the_range_at_the_cut(spark):
    from harborlight.operators import filters

    prefix = filters.prefix_of_ranges(spark.range(1000).toDF("k"), ["k"], 600)
    assert prefix.count() == 600
    text = prefix._jdf.queryExecution().optimizedPlan().toString()
    whole, cut = text.index("_range"), text.index("GlobalLimit") if "GlobalLimit" in text else text.index("Limit")
    assert text.count("Limit") <= 2 and "Sort" in text[cut:] and whole >= 0
    assert prefix.agg(F.max("k")).first()[0] == 599


def test_file_order_of_odd_names(spark):
    """The order text by a rule in plain Python: folder, name with its number padded, rotation."""
    names = ["", "/", "a/", "/a/0.log", "/a/0.log.", "/a/12.log.20240101-000000", "a.logx.log", "x.log.log.1", "7", "é/é9.log", "..log"]

    def expected(path):
        folder, slash, name = path.rpartition("/")
        end = (name + ".").find(".log.")
        stem, suffix = (name, "") if end < 0 else (name[:end], name[end + 5 :])
        rest = stem.lstrip("0123456789")
        number = stem[: len(stem) - len(rest)]
        return folder + slash + (number.rjust(20, "0") if number else "") + rest + "|" + (suffix or "~")

    rows = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r[0]: r[1] for r in rows.select("path", positional.file_order(F.col("path"))).collect()}
    assert got == {n: expected(n) for n in names}
    assert rows.select(positional.file_order(F.lit(None).cast("string"))).first()[0] is None
