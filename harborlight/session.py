"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# All times are formatted and truncated in UTC; duplicate JSON keys resolve to
# the last one; AQE splits skewed join partitions and coalesces small ones.
REQUIRED_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also split a hot key when a later grouping would reuse the join's partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # compressed bytes: parsed telemetry grows ten- to fiftyfold in a sort, which is what a task must hold
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a LIMIT larger than this becomes a spillable range sort instead of an
    # in-memory heap per task
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
    "spark.sql.files.ignoreMissingFiles": "true",
    # half the bytes and less work than the default of 96 bits, and the same microseconds
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # folders of one small file each: a listing in 10,000 tasks (the default) is mostly task starts
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
    # the JVM does not compile methods beyond 8000 bytecodes: a fused stage larger
    # than that would be interpreted, so such stages run operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every operator assumes; returns the session."""
    for key, value in REQUIRED_SQL_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary
    folder: on a cluster a machine-local path would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id", "local")
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="harborlight-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
