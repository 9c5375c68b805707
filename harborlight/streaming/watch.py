"""Event watch with a merged table, in the order events arrive.

Each trigger merges its events into the stored state: the first arrival describes an
event, counts add up, the last time is that of the latest arrival that has one.
Arrival is the trigger, then the place in the files; versions and times inside the
objects do not matter.

The state lies in buckets by a hash of the merge key.  A trigger reads and writes only the
buckets its events fall into, so its cost follows the trigger and not the state.  Each bucket
has two generations that are written in turn, and a small manifest per trigger, kept twice
in the same way, names the valid one: a trigger that fails or is repeated finds the state
before it untouched, and storage does not grow with the number of triggers.

Files must be landed closed, by renaming: a file is read once, and lines appended to it
later are not seen (:mod:`harborlight.sources.growing` reads those).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from harborlight import schemas
from harborlight.functions.times import instant
from harborlight.operators import events
from harborlight.operators.enrich import with_source
from harborlight.operators.positional import number_lines, place_of
from harborlight.operators.winners import stored

BATCH = "batch_id"
GENERATIONS = 2
#: buckets of a new state; one that exists keeps its own number
BUCKETS = 32

_KEY = "deduplication_key"
_FIRST = T.StructType([schemas.CLUSTER_EVENTS[c] for c in events.FIRST_ARRIVAL])
_STATE = T.StructType(
    [
        T.StructField(_KEY, T.StringType()),
        T.StructField("first", _FIRST),
        T.StructField("last_timestamp", T.TimestampType()),
        T.StructField("count", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("generation", T.IntegerType()),
    ]
)
_MANIFEST = f"{BATCH} long, buckets int, bucket int, generation int, newest timestamp, edge timestamp, taken long"


@dataclass
class Manifest:
    """Valid generation by bucket as of a trigger, the newest time, and the oldest that is kept.

    ``taken`` counts the events of a backlog that the state holds (:mod:`harborlight.streaming.backlog`).
    """

    buckets: int
    generations: dict[int, int]
    newest: dt.datetime | None = None
    edge: dt.datetime | None = None
    taken: int = 0
    batch_id: int = -1


def watch_to_table(
    lines: DataFrame,
    path: str,
    checkpoint: str,
    *,
    as_of: dt.datetime | None = None,
    since: dt.datetime | None = None,
    cluster_name: str = "",
    watch: bool = False,
    forget_after: dt.timedelta | None = None,
    until_idle: bool = True,
    buckets: int = BUCKETS,
    **event_filters,
) -> StreamingQuery:
    """Keep the merged events of ``lines`` (:func:`sources.landed.stream_placed_lines`) at ``path``.

    State grows by one row per merge key; ``forget_after`` bounds it by dropping keys whose
    time is older than that before the newest one, whose later copies start anew.  Such rows
    are passed over by every reader and leave the files when their bucket is next written.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        placed = number_lines(batch)
        place = place_of(placed)
        needed = events.needed_for({**event_filters, "since": since})
        parsed = events.parse_events(
            placed, as_of=as_of, cluster_name=cluster_name, keep=place, watch=watch, columns=needed
        )
        rows = events.filter_events(parsed, since=since, **event_filters)
        spark = batch.sparkSession
        before = _manifest(spark, path, batch_id) or Manifest(buckets, {})
        fresh = events.first_and_last(rows, place, unique="line_no" not in batch.columns)
        write_manifest(spark, path, batch_id, merge_into(spark, path, before, fresh, forget_after))

    writer = lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_idle else writer).start()


def merge_into(
    spark: SparkSession,
    path: str,
    before: Manifest,
    fresh: DataFrame,
    forget_after: dt.timedelta | None = None,
) -> Manifest:
    """Merge new events, one row per key, behind the state of ``before``; valid once its manifest is written."""
    bucket = F.pmod(F.xxhash64(_KEY), F.lit(before.buckets)).cast("int")
    # read for its buckets and again for its rows
    fresh = stored(fresh.withColumn("bucket", bucket), "fresh-events")
    touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())
    if touched:
        merged = _merged(_valid(spark, path, before, touched), fresh)
        _write(merged.repartition("bucket"), path, before, touched)
    return _next(spark, path, before, touched, forget_after)


def watched_events(spark: SparkSession, path: str, cluster_name: str = "") -> DataFrame:
    """The merged events as of the last trigger."""
    manifest = _manifest(spark, path, None)
    if manifest is None or not manifest.generations:
        return spark.createDataFrame([], schemas.CLUSTER_EVENTS)
    state = _valid(spark, path, manifest, sorted(manifest.generations))
    return schemas.conform(
        with_source(events.merged_rows(state), events.SOURCE_TYPE, cluster_name),
        schemas.CLUSTER_EVENTS,
    )


def _valid(spark: SparkSession, path: str, manifest: Manifest, buckets: list[int]) -> DataFrame:
    """State rows of ``buckets``; only the folders of their valid generations are read."""
    chosen = F.lit(False)
    for generation in range(GENERATIONS):
        mine = [b for b in buckets if manifest.generations.get(b) == generation]
        if mine:
            chosen = chosen | ((F.col("generation") == generation) & F.col("bucket").isin(mine))
    if not any(b in manifest.generations for b in buckets):
        return spark.createDataFrame([], _STATE)
    state = spark.read.schema(_STATE).parquet(f"{path}/rows").where(chosen)
    if manifest.edge is not None:
        time = F.coalesce("last_timestamp", "first.timestamp")
        state = state.where(time >= instant(manifest.edge))
    return state


def _merged(before: DataFrame, fresh: DataFrame) -> DataFrame:
    """Both sides hold one row per key; what was there before came first."""
    old, new = before.alias("old"), fresh.hint("shuffle_hash").alias("new")
    joined = old.join(new, F.col(f"old.{_KEY}") == F.col(f"new.{_KEY}"), "full")
    either = [F.coalesce(f"old.{c}", f"new.{c}").alias(c) for c in (_KEY, "first", "bucket")]
    counts = [F.coalesce(f"{side}.count", F.lit(0)) for side in ("old", "new")]
    return joined.select(
        *either,
        F.coalesce("new.last_timestamp", "old.last_timestamp").alias("last_timestamp"),
        (counts[0] + counts[1]).alias("count"),
    )


def _turned(manifest: Manifest, bucket: int) -> int:
    """The generation of a bucket that is free to be written."""
    return (manifest.generations.get(bucket, GENERATIONS - 1) + 1) % GENERATIONS


def _write(merged: DataFrame, path: str, before: Manifest, touched: list[int]) -> None:
    """Replace the free generation of every touched bucket, and nothing else."""
    ones = [b for b in touched if _turned(before, b) == 1]
    generation = F.when(F.col("bucket").isin(ones), 1).otherwise(0) if ones else F.lit(0)
    (
        merged.withColumn("generation", generation)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "generation")
        .parquet(f"{path}/rows")
    )


def _next(
    spark: SparkSession, path: str, before: Manifest, touched: list[int], forget_after: dt.timedelta | None
) -> Manifest:
    turned = {b: _turned(before, b) for b in touched}
    now = Manifest(before.buckets, before.generations | turned, before.newest)
    if forget_after is not None:
        rows = _valid(spark, path, now, touched)
        times = [before.newest, rows.agg(F.unix_micros(F.max("first.timestamp"))).first()[0] if touched else None]
        known = [_moment(t) for t in times if t is not None]
        now.newest = max(known, default=None)
        now.edge = now.newest - forget_after if now.newest is not None else None
    return now


def _moment(value: int | dt.datetime) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=value)


def write_manifest(spark: SparkSession, path: str, batch_id: int, manifest: Manifest) -> None:
    """One row per bucket, over the manifest of the trigger before the last one."""
    rows = [
        (batch_id, manifest.buckets, b, g, manifest.newest, manifest.edge, manifest.taken)
        for b, g in manifest.generations.items() or [(None, None)]
    ]
    frame = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/manifest/turn={batch_id % GENERATIONS}")


def last_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest of the last trigger or run."""
    return _manifest(spark, path, None)


def _manifest(spark: SparkSession, path: str, batch_id: int | None) -> Manifest | None:
    """The manifest of the last trigger before ``batch_id``, or the last of all."""
    found: tuple[int, Manifest] | None = None
    for turn in range(GENERATIONS):
        try:
            kept = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest/turn={turn}")
            times = [F.unix_micros(c).alias(c) for c in ("newest", "edge")]
            rows = kept.select(BATCH, "buckets", "bucket", "generation", "taken", *times).collect()
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            continue
        if not rows:
            continue
        first = rows[0]
        if (batch_id is None or first[BATCH] < batch_id) and (found is None or first[BATCH] > found[0]):
            generations = {r["bucket"]: r["generation"] for r in rows if r["bucket"] is not None}
            newest, edge = (None if first[c] is None else _moment(first[c]) for c in ("newest", "edge"))
            state = Manifest(first["buckets"], generations, newest, edge, first["taken"] or 0, first[BATCH])
            found = (first[BATCH], state)
    return found[1] if found else None
