"""An event watch that takes an exact number of events per run.

A trigger of a file stream takes whole files, so a bound on rows cannot be kept inside it.
Here landing and merging are two steps:

* :func:`land_events` streams parsed and filtered events into a backlog.  Each event gets its number
  in the order of arrival: the trigger, then the place in the files.
* :func:`merge_next` takes the next ``most_events`` numbers, no more and no fewer if there are so many,
  and merges them into the state of :mod:`harborlight.streaming.watch`.  The state's manifest says how many
  were taken, so the rest waits for the next run, and a run that fails is repeated with the same events.

Numbers are given by splits of files, in which rows stand in their order, or else by ranges of the order;
the sizes of either are added up, and no task sees a whole trigger.
A state belongs to one backlog and must not be fed by ``watch_to_table`` as well; land and merge
one after the other.  Taken events stay in the backlog's folders, one per trigger.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harborlight.operators import events, options
from harborlight.operators.positional import FILE_ORDER, PLACE, file_order, number_lines, place_of
from harborlight.operators.winners import stored
from harborlight.streaming import watch

NUMBER = "arrival"
TURNS = 2
_KEPT = list(events.MERGED_COLUMNS)
_AT = "_at"
_PART = "_part"
#: monotonically_increasing_id holds the partition above this many bits
_ROW_BITS = 33
_ENDS = "batch_id long, end long"


def land_events(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    as_of: dt.datetime | None = None,
    since: dt.datetime | None = None,
    cluster_name: str = "",
    watch: bool = False,
    until_idle: bool = True,
    **event_filters,
) -> StreamingQuery:
    """Append the events of ``lines`` (:func:`sources.landed.stream_placed_lines`) to the backlog at ``path``.

    A repeated trigger writes its own folder again, under the same numbers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placed = number_lines(batch)
        place = place_of(placed)
        needed = events.needed_for({**event_filters, "since": since})
        parsed = events.parse_events(
            placed, as_of=as_of, cluster_name=cluster_name, keep=place, watch=watch, columns=needed
        )
        rows = events.filter_events(parsed, since=since, **event_filters)
        rows = rows.select(*_KEPT, *PLACE, F.monotonically_increasing_id().alias(_AT))
        rows = stored(rows, "backlog-rows")
        first = landed(spark, path, batch_id)
        numbered = None if "line_no" in batch.columns else _numbered_by_split(rows, first)
        if numbered is None:
            numbered = _numbered(rows.withColumn(FILE_ORDER, file_order(F.col("file_path"))), place, first)
        numbered = numbered.select(*_KEPT, NUMBER)
        numbered.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        end = spark.createDataFrame([(batch_id, first + rows.count())], _ENDS).coalesce(1)
        end.write.mode("overwrite").parquet(f"{path}/ends/turn={batch_id % TURNS}")

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_idle else writer).start()


def _numbered_by_split(rows: DataFrame, first: int) -> DataFrame | None:
    """As :func:`_numbered`, without moving rows: one task read a whole split in order and counted its rows by _AT.

    None if the rows of some split do not follow each other.
    """
    split = PLACE[:-1]
    low, n = F.min(_AT).alias("low"), F.count(F.lit(1)).alias("n")
    sizes = stored(rows.groupBy(*split).agg(low, F.max(_AT).alias("high"), n), "backlog-splits")
    if not sizes.where(F.col("high") - F.col("low") + 1 != F.col("n")).isEmpty():
        return None
    # one row per split of a trigger's files
    before = Window.orderBy(file_order(F.col("file_path")), *split).rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(first).cast("long") + F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")
    starts = sizes.select(*[F.col(c).alias(f"_{c}") for c in split], start.alias("start"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in split]
    return rows.join(F.broadcast(starts), reduce(and_, same)).withColumn(NUMBER, F.col("start") + F.col(_AT))


def _numbered(rows: DataFrame, place: list[str], first: int) -> DataFrame:
    """Adds consecutive numbers from ``first`` on, in the order of ``place``."""
    ranged = rows.repartitionByRange(*place).sortWithinPartitions(*place)
    ranged = stored(ranged.withColumn(_AT, F.monotonically_increasing_id()), "backlog-ranges")
    ranged = ranged.withColumn(_PART, F.shiftright(_AT, _ROW_BITS))
    # one row per range, as many as there are shuffle partitions
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    index = F.col(_AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    number = F.lit(first).cast("long") + F.col("start") + index
    return ranged.join(F.broadcast(starts), _PART).withColumn(NUMBER, number)


def landed(spark: SparkSession, path: str, batch_id: int | None = None) -> int:
    """Number of events in the backlog as of its last finished trigger, or the last before ``batch_id``."""
    newest, end = -1, 0
    for turn in range(TURNS):
        try:
            row = spark.read.schema(_ENDS).parquet(f"{path}/ends/turn={turn}").first()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if row and row[0] > newest and (batch_id is None or row[0] < batch_id):
            newest, end = row
    return end


def merge_next(
    spark: SparkSession,
    backlog: str,
    path: str,
    most_events: int | None = None,
    *,
    forget_after: dt.timedelta | None = None,
    buckets: int = watch.BUCKETS,
) -> int:
    """Merge the next ``most_events`` events (all, if None) into the state; how many these were."""
    options.non_negative("most_events", most_events)
    before = watch.last_manifest(spark, path) or watch.Manifest(buckets, {})
    n = landed(spark, backlog) - before.taken
    if most_events is not None:
        n = min(n, most_events)
    if n <= 0:
        return 0
    number = F.col(NUMBER)
    rows = spark.read.parquet(f"{backlog}/rows")
    rows = rows.where((number >= before.taken) & (number < before.taken + n))
    fresh = events.first_and_last_numbered(rows, NUMBER)
    now = watch.merge_into(spark, path, before, fresh, forget_after)
    now.taken = before.taken + n
    watch.write_manifest(spark, path, before.batch_id + 1, now)
    return n
