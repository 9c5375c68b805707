"""Small frames and plan text for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lines(spark, *texts: str) -> DataFrame:
    """One row per text with its position."""
    return spark.createDataFrame(
        [(t, i) for i, t in enumerate(texts)], "value string, line_no long"
    ).coalesce(1)


def by_line(df: DataFrame, *columns: str) -> dict[int, object]:
    """line_no → value (or tuple of values)."""
    rows = df.select("line_no", *columns).collect()
    return {r[0]: r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows}


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
