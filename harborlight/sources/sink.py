"""Partitioned tables of collected rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.functions.times import utc
from harborlight.operators.collect_once import ROW_ID, ROW_MS, not_yet_collected

PARTITIONS = ["tp_partition", "tp_date"]

DAY = "tp_date"

# What each table is usually restricted to, for tables written whole.
TABLE_PARTITIONS = {
    "pod_logs": [DAY, "namespace"],
    "cluster_events": [DAY, "event_type"],
    "cluster_resources": ["resource_type"],
    "audit_logs": PARTITIONS,
}
# The time that gives a row its UTC day, and by which rows are sorted inside each file.
TABLE_TIMES = {
    "pod_logs": "timestamp",
    "cluster_events": "timestamp",
    "audit_logs": "stage_timestamp",
}


def write_partitioned(
    df: DataFrame, path: str, mode: str = "append", partitions: Sequence[str] = PARTITIONS
) -> None:
    """Parquet by partition columns, for audit entries partition name and day.

    Rows are rebalanced on the partition columns first: small partitions share
    a task, a huge one is split over many, and no task writes to every folder.
    """
    rebalanced = df.hint("rebalance", *partitions)
    rebalanced.write.mode(mode).partitionBy(*partitions).parquet(path)


def write_table(df: DataFrame, path: str, table: str, mode: str = "append") -> None:
    """One of the four tables by its usual partitions, with a day column where it has a time.

    Rows without a time have a partition of their own.  Rows are sorted by time inside
    each file, so row-group statistics narrow a time range further than the day does.
    """
    partitions, time = TABLE_PARTITIONS[table], TABLE_TIMES.get(table)
    if time is not None and DAY not in df.columns:
        df = df.withColumn(DAY, F.to_date(time))
    rows = df.hint("rebalance", *partitions)
    if time is not None:
        rows = rows.sortWithinPartitions(*partitions, time)
    rows.write.mode(mode).partitionBy(*partitions).parquet(path)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def append_new_rows(
    df: DataFrame,
    path: str,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> None:
    """Append the rows not yet in the table at ``path``.

    ``df`` carries the collect key; of rows with one key inside it a single one is kept.
    ``since`` and ``until`` are the collected
    range: only days inside it are looked up, rows without a day always are.
    """
    spark = df.sparkSession
    df = df.dropDuplicates([ROW_ID, ROW_MS])
    try:
        collected = read_partitioned(spark, path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        collected = None
    if collected is not None:
        day = F.col("tp_date")
        if since is not None:
            collected = collected.where(day.isNull() | (day >= F.lit(utc(since).date())))
        if until is not None:
            collected = collected.where(day.isNull() | (day <= F.lit(utc(until).date())))
        df = not_yet_collected(df, collected.select(ROW_ID, ROW_MS))
    write_partitioned(df, path)
