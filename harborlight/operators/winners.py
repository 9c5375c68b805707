"""Pick rows by key without sorting or moving whole rows.

Aggregations that keep a whole row per key (``min_by`` of a struct) have buffers of variable
width, so Spark sorts complete rows by key and sends one per key and task through the
shuffle.  Here rows are stored once with a number of their own; only keys, fixed-width
order columns and row numbers are aggregated, by hash and combined before the shuffle, and
the winning rows are then picked out of the stored ones by number.

An interrupted job leaves its scratch folder behind and starts anew with another one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlight.operators.positional import FILE_ORDER, PLACE, file_order
from harborlight.session import scratch_dir

ROW = "_row"
#: numbers of rows, eight bytes each, that are sent to every task; more are shuffled
BROADCAST_NUMBERS = 2_000_000

POSITION = "_position"
RANK = "_rank"
AT = "_at"
_BEST = "_best"
#: a decimal of 38 digits holds two of them side by side
_SPAN = 1 << 62


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again, which cuts its lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(high: Column, low: Column) -> Column:
    """One fixed-width number that orders by ``high``, then ``low`` (0 to 2^62)."""
    return high.cast("decimal(20,0)") * F.lit(_SPAN).cast("decimal(19,0)") + low.cast("decimal(19,0)")


def ranked(
    df: DataFrame, purpose: str, order: Sequence[Column | str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Stored rows (of columns ``keep``) with ROW, and their place as RANK and AT.

    The order's last column is a number, AT; those before it, such as file and split of a line,
    have few distinct values and count by their RANK among them.
    """
    kept = df.columns if keep is None else list(keep)
    # the order of a file follows from its path, and is found per file instead of per line
    by_path = list(order) == [FILE_ORDER, *PLACE]
    columns = [F.col(c) if isinstance(c, str) else c for c in (PLACE if by_path else order)]
    names = [f"{POSITION}_{i}" for i in range(len(columns))]
    placed = [c.alias(n) for n, c in zip(names, columns, strict=True)]
    rows = stored(df.select(*kept, F.monotonically_increasing_id().alias(ROW), *placed), purpose)
    *lead, last = names
    at = F.coalesce(F.col(last), F.lit(0 if lead else -_SPAN)).alias(AT)
    if not lead:
        return rows.select(*kept, ROW, F.lit(0).alias(RANK), at)
    sorted_by = [file_order(F.col(lead[0])), *lead] if by_path else lead
    rank = F.row_number().over(Window.orderBy(*sorted_by)).alias(RANK)
    ranks = stored(rows.select(*lead).distinct().select(*[F.col(c).alias(f"r{c}") for c in lead], rank), "ranks")
    met = rows.join(ranks, reduce(and_, [F.col(c).eqNullSafe(F.col(f"r{c}")) for c in lead]))
    return met.select(*kept, ROW, RANK, at)


def numbered(
    df: DataFrame, purpose: str, order: Sequence[Column | str] = (), keep: Sequence[str] | None = None
) -> DataFrame:
    """Stored rows (of columns ``keep``) with ROW, and POSITION if there is an ``order`` as of :func:`ranked`."""
    if not order:
        kept = df.columns if keep is None else keep
        return stored(df.select(*kept, F.monotonically_increasing_id().alias(ROW)), purpose)
    rows = ranked(df, purpose, order, keep)
    place = F.col(AT) if len(order) == 1 else side_by_side(F.col(RANK), F.col(AT))
    return rows.withColumn(POSITION, place).drop(RANK, AT)


def tied(rows: DataFrame, keys: Sequence[str], last: bool = False) -> DataFrame:
    """The rows of every key that are first (or last) by POSITION: one hash aggregation, one join."""
    extreme = F.max if last else F.min
    best = rows.groupBy(*[F.col(k).alias(f"{_BEST}_{k}") for k in keys]).agg(extreme(POSITION).alias(_BEST))
    same = [F.col(k).eqNullSafe(F.col(f"{_BEST}_{k}")) for k in keys]
    met = rows.join(best, reduce(and_, same)).where(F.col(POSITION) == F.col(_BEST))
    return met.select(*rows.columns)


def least_row(tie: Column | None = None) -> Column:
    """Aggregate: the ROW of a group that is least by ``tie``, a hash of the content."""
    if tie is None:
        return F.min(ROW)
    least = F.min(side_by_side(tie, F.col(ROW)))
    span = F.lit(_SPAN).cast("decimal(19,0)")
    return F.pmod(least, span).cast("long")


def by_number(rows: DataFrame, facts: DataFrame, how: str, purpose: str) -> DataFrame:
    """``rows`` joined with narrow, fixed-width ``facts`` by ROW; the wide side is never sorted.

    The facts are stored and counted: few are broadcast, many are shuffled and built into
    hash tables.
    """
    facts = stored(facts, purpose)
    few = facts.count() <= BROADCAST_NUMBERS
    return rows.join(F.broadcast(facts) if few else facts.hint("shuffle_hash"), ROW, how)
