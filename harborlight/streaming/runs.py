"""Running streams: resumable, bounded by "until idle" or by time.

A run that is started again with the same checkpoint continues where the last
one stopped, so there is no reconnect loop here.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from harborlight.sources.by_tasks import listing_failure, rows_read

BATCH = "batch_id"


def append_to_table(
    df: DataFrame, path: str, checkpoint: str, until_idle: bool = True
) -> StreamingQuery:
    """Append rows to Parquet, each exactly once across restarts."""
    writer = df.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return _start(writer, until_idle)


def update_to_table(
    df: DataFrame, path: str, checkpoint: str, until_idle: bool = True
) -> StreamingQuery:
    """Write the changed rows of every trigger below ``path/batch_id=<n>``.

    A repeated trigger overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(write)
    return _start(writer.option("checkpointLocation", checkpoint), until_idle)


def _start(writer, until_idle: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if until_idle else writer).start()


def finish(
    query: StreamingQuery, timeout_seconds: float | None = None, most_rows: int | None = None
) -> bool:
    """Wait for an until-idle run, or stop any run after a time or a number of input rows.

    True if the run ended itself.  Rows are counted per finished trigger, so the last one
    may go beyond ``most_rows``.  A run that was stopped as its files could not be listed fails.
    """
    ended = _ended(query, timeout_seconds, most_rows)
    failed = listing_failure(query)
    if failed is not None:
        raise RuntimeError("the run was stopped, as its files could not be listed") from failed
    return ended


def _ended(query: StreamingQuery, timeout_seconds: float | None, most_rows: int | None) -> bool:
    if most_rows is None:
        if timeout_seconds is None:
            query.awaitTermination()
            return True
        ended = query.awaitTermination(timeout_seconds)
    else:
        deadline = None if timeout_seconds is None else time.monotonic() + timeout_seconds
        seen: dict[int, int] = {}
        ended = False
        while not ended and sum(seen.values()) < most_rows:
            if deadline is not None and time.monotonic() >= deadline:
                break
            ended = query.awaitTermination(0.2)
            seen.update((p["batchId"], rows_read(p)) for p in query.recentProgress)
    if not ended:
        query.stop()
    return ended


def latest_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest version of every key written by :func:`update_to_table`."""
    changes = spark.read.parquet(path)
    columns = [c for c in changes.columns if c not in (key, BATCH)]
    newest = changes.groupBy(key).agg(F.max_by(F.struct(*columns), BATCH).alias("newest"))
    return newest.select(key, "newest.*")
