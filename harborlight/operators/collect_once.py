"""Collect every row once, also across overlapping runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.operators.winners import POSITION, ROW, by_number, least_row, numbered, stored, tied

ROW_ID = "row_id"
ROW_MS = "row_ms"


def with_collect_key(df: DataFrame, identity: Column, time: Column) -> DataFrame:
    """Add the identity and the time at millisecond granularity."""
    return df.withColumns({ROW_ID: identity, ROW_MS: F.unix_millis(time)})


def surplus(rows: DataFrame) -> DataFrame:
    """(ROW): numbers of all rows but the first of each key.

    Keys that occur once, nearly all of them as a rule, leave after a count; only the rows of
    the others are compared.
    """
    keys = [ROW_ID, ROW_MS]
    placed = [POSITION] if POSITION in rows.columns else []
    narrow = rows.select(*keys, *placed, ROW)
    repeated = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    named = repeated.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.col(ROW_ID).eqNullSafe(F.col(f"_{ROW_ID}")) & F.col(ROW_MS).eqNullSafe(F.col(f"_{ROW_MS}"))
    compared = stored(narrow.join(named, same, "left_semi"), "repeated-keys")
    first = tied(compared, keys) if placed else compared
    kept = first.groupBy(*keys).agg(least_row().alias(ROW))
    return compared.join(kept.select(ROW), ROW, "left_anti").select(ROW)


def collect_once(df: DataFrame, order: Sequence[Column | str] = ()) -> DataFrame:
    """The first row by ``order`` of every (identity, millisecond); ties go to any one of them.

    Rows are stored once.  What travels are keys and row numbers; rows move only if very many
    are surplus, and are never sorted.  A hot identity does not gather its copies in one task.
    """
    rows = numbered(df, "collect-once", order)
    once = by_number(rows, surplus(rows), "left_anti", "surplus-rows")
    kept = [c for c in df.columns if c not in (ROW_ID, ROW_MS)]
    return once.select(*kept, ROW_ID, ROW_MS)


def not_yet_collected(df: DataFrame, collected: DataFrame) -> DataFrame:
    """Rows whose key is not among the collected keys."""
    keys = collected.select(ROW_ID, ROW_MS)
    match = (df[ROW_ID] == keys[ROW_ID]) & df[ROW_MS].eqNullSafe(keys[ROW_MS])
    return df.join(keys, match, "left_anti")
