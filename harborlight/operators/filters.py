"""Predicates shared by the tables.

Every helper takes an option that may be empty and returns the frame unchanged
then, so unset options leave no trace in the plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.functions.text import or_empty
from harborlight.operators.winners import stored


def where_if(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.where(condition)


def member(df: DataFrame, column: str, allowed: Iterable | None) -> DataFrame:
    """Exact, case-sensitive membership; a NULL text compares as empty."""
    values = list(allowed or [])
    if not values:
        return df
    if "" in values:
        return df.where(or_empty(F.col(column)).isin(values))
    # a plain IN list drops NULLs and reaches the file reader
    return df.where(F.col(column).isin(values))


def overlaps(df: DataFrame, column: str, allowed: Iterable[str] | None) -> DataFrame:
    """At least one element of the array column is allowed."""
    values = list(allowed or [])
    if not values:
        return df
    return df.where(F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values])))


def search(df: DataFrame, column: str, regex: str | None) -> DataFrame:
    """Unanchored pattern search; a NULL text is searched as empty."""
    return df if not regex else df.where(or_empty(F.col(column)).rlike(regex))


def in_namespaces(
    df: DataFrame, namespaces: Sequence[str], column: str = "namespace", pass_unscoped: bool = False
) -> DataFrame:
    """``*`` anywhere in the list means all. ``pass_unscoped`` keeps rows without one."""
    if not namespaces or "*" in namespaces:
        return df
    if pass_unscoped:
        listed = F.col(column).isin(list(namespaces))
        return df.where(F.col(column).isNull() | (F.col(column) == "") | listed)
    return member(df, column, namespaces)


def has_labels(
    terms: Sequence[tuple[str, str, Sequence[str]]], column: str = "labels"
) -> Column | None:
    """All label terms hold on a map column; a missing label differs from every value."""
    condition: Column | None = None
    for key, test, values in terms:
        value = F.try_element_at(F.col(column), F.lit(key))
        term = {
            "in": lambda: F.coalesce(value.isin(list(values)), F.lit(False)),
            "notin": lambda: value.isNull() | ~value.isin(list(values)),
            "exists": value.isNotNull,
            "absent": value.isNull,
        }[test]()
        condition = term if condition is None else condition & term
    return condition


#: a longer prefix is not taken by the tasks' heaps but cut out of ranges
HEAP_ROWS = 100_000
_RANGE = "_range"


def first_rows(df: DataFrame, order: Sequence[Column | str], limit: int | None) -> DataFrame:
    """A prefix of a stable order, in that order, so the same rows come back on every run."""
    if limit is None or limit <= HEAP_ROWS:
        return df if limit is None else df.orderBy(*order).limit(limit)
    return prefix_of_ranges(df, order, limit).orderBy(*order)


def prefix_of_ranges(df: DataFrame, order: Sequence[Column | str], limit: int) -> DataFrame:
    """The first ``limit`` rows without bringing them together in one task.

    Rows are stored once and dealt into ranges of the order, whose sizes tell in which range
    the prefix ends: all rows of the ranges before belong to it, and only the rows of that one
    range are ranked.
    """
    rows = stored(df, "prefix-rows")
    ranged = rows.repartitionByRange(*order).withColumn(_RANGE, F.spark_partition_id())
    ranged = stored(ranged, "prefix-ranges")
    before = 0
    for number, n in sorted(ranged.groupBy(_RANGE).agg(F.count(F.lit(1))).collect()):
        if before + n >= limit:
            whole = ranged.where(F.col(_RANGE) < number)
            part = ranged.where(F.col(_RANGE) == number).orderBy(*order).limit(limit - before)
            return whole.unionByName(part).drop(_RANGE)
        before += n
    return ranged.drop(_RANGE)
