"""First rows, last rows and byte budgets per group, without one task per group.

A group (a container, a file) may hold a third of all lines, so no operator
here sends a whole group to one task.  Rows are ordered by ``order``: columns
ending in an integer that is unique within the leading ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Order of lines read from files.
PLACE = ["file_path", "block_start", "line_no"]
# Order of the files themselves, where it is not that of their paths.
FILE_ORDER = "file_order"

# Up to this many rows per group a row_number filter is planned as a partial and
# final group limit (spark.sql.optimizer.windowGroupLimitThreshold default).
SMALL_LIMIT = 1000
# Scan partitions of one group are first limited in this many buckets.
BUCKETS = 256
# 2^16 positions per chunk: no chunk of a group can hold more rows than this.
CHUNK_BITS = 16

_BUCKET = "_bucket"
_RANK = "_rank"
_CHUNK = "_chunk"
_WEIGHT = "_weight"
_BEFORE = "_before"
_RUNNING = "_running"


def number_lines(df: DataFrame) -> DataFrame:
    """Complete the place of lines read from files; numbered lines stay as they are.

    One task reads a whole split in order, so the number within the task orders
    the lines of a split.  Apply filters on path keys first.
    """
    if "line_no" in df.columns:
        return df
    return df.withColumn("line_no", F.monotonically_increasing_id())


def place_of(df: DataFrame) -> list[str]:
    """The columns that order the lines of a frame."""
    if FILE_ORDER in df.columns:
        return [FILE_ORDER, *PLACE]
    return PLACE if "file_path" in df.columns else ["line_no"]


def file_order(path: Column) -> Column:
    """A text by which files of one folder sort in the order they were written.

    A rotated file (``0.log.20240101-000000``, ``audit-2024-01-01.log``) comes before the one
    still written (``0.log``, ``audit.log``), and leading numbers count as numbers.
    """
    # plain string functions, as this runs for every line
    name = F.substring_index(path, "/", -1)
    folder = F.substr(path, F.lit(1), F.char_length(path) - F.char_length(name))
    end = F.instr(F.concat(name, F.lit(".")), ".log.")  # 0: no such ending
    stem = F.when(end > 0, F.substr(name, F.lit(1), end - 1)).otherwise(name)
    rest = F.ltrim(stem, F.lit("0123456789"))
    number = F.substr(stem, F.lit(1), F.char_length(stem) - F.char_length(rest))
    counted = F.concat(F.lpad(number, 20, "0"), rest)
    suffix = F.when(end > 0, F.substr(name, end + 5)).otherwise("")
    return F.concat(
        folder,
        F.when(number != "", counted).otherwise(stem),
        F.lit("|"),  # sorts behind the marks that continue a name
        F.when(suffix != "", suffix).otherwise("~"),
    )


def head_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    small_limit: int = SMALL_LIMIT,
) -> DataFrame:
    """The first ``n`` rows of every group."""
    return _limit_rows(df, keys, order, n, False, small_limit)


def tail_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    small_limit: int = SMALL_LIMIT,
) -> DataFrame:
    """The last ``n`` rows of every group."""
    return _limit_rows(df, keys, order, n, True, small_limit)


def bytes_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size: Column,
    max_bytes: int,
    group_rows: int | None = None,
) -> DataFrame:
    """The leading rows of every group whose (positive) sizes add up to at most ``max_bytes``.

    ``group_rows`` states a known bound on rows per group, for instance after a
    tail; small groups need no chunking.
    """
    weight = size.cast("long")
    if group_rows is None or group_rows > SMALL_LIMIT:
        return _within_budget(df, keys, order, weight, max_bytes, False)
    window = Window.partitionBy(*keys).orderBy(*_sorted(order, False))
    running = F.sum(weight).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(_RUNNING, running).where(F.col(_RUNNING) <= max_bytes).drop(_RUNNING)


def _limit_rows(df, keys, order, n, last_first, small_limit) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    if n <= small_limit:
        return _ranked_twice(df, keys, order, n, last_first)
    return _within_budget(df, keys, order, F.lit(1).cast("long"), n, last_first)


def _sorted(order: Sequence[str | Column], last_first: bool) -> list[Column]:
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return [c.desc() if last_first else c.asc() for c in columns]


def _ranked_twice(df, keys, order, n, last_first) -> DataFrame:
    """Limit per (group, scan bucket), then per group.

    The map side keeps at most n rows per group and scan partition; the bucket
    step bounds what the final window of one group receives to BUCKETS * n.
    """
    bucketed = df.withColumn(_BUCKET, F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
    for partition in ([*keys, _BUCKET], list(keys)):
        window = Window.partitionBy(*partition).orderBy(*_sorted(order, last_first))
        bucketed = (
            bucketed.withColumn(_RANK, F.row_number().over(window))
            .where(F.col(_RANK) <= n)
            .drop(_RANK)
        )
    return bucketed.drop(_BUCKET)


def _within_budget(df, keys, order, weight, budget, last_first) -> DataFrame:
    """Keep rows while the running weight of their group stays within ``budget``.

    Weights are summed per chunk of consecutive positions (map-side combined),
    running totals are taken over those few sums, chunks that start beyond the
    budget are dropped by the join, and only rows of the same chunk are ranked
    together.
    """
    *lead, position = order
    weighted = df.withColumn(
        _CHUNK, F.shiftright(F.col(position).cast("long"), CHUNK_BITS)
    ).withColumn(_WEIGHT, weight)
    chunk_keys = [*keys, *lead, _CHUNK]
    before = Window.partitionBy(*keys).orderBy(*_sorted([*lead, _CHUNK], last_first))
    reachable = (
        weighted.groupBy(*chunk_keys)
        .agg(F.sum(_WEIGHT).alias(_WEIGHT))
        .withColumn(
            _BEFORE,
            F.coalesce(
                F.sum(_WEIGHT).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .where(F.col(_BEFORE) < budget)
        .drop(_WEIGHT)
    )
    within = Window.partitionBy(*chunk_keys).orderBy(*_sorted([position], last_first))
    # a missing key is a group of its own, so NULL must meet NULL
    named = reachable.select(
        *[F.col(k).alias(f"_reach_{i}") for i, k in enumerate(chunk_keys)], _BEFORE
    )
    same = [F.col(k).eqNullSafe(F.col(f"_reach_{i}")) for i, k in enumerate(chunk_keys)]
    return (
        weighted.join(named, reduce(and_, same))
        .withColumn(
            _RUNNING,
            F.col(_BEFORE)
            + F.sum(_WEIGHT).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )
        .where(F.col(_RUNNING) <= budget)
        .select(*df.columns)
    )
