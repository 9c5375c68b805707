"""Scans of landed telemetry.

Layouts: container logs as ``namespace=<ns>/pod_name=<pod>/container_name=<c>/*``
text files, so the container keys are partition columns and prune files; events,
objects and audit entries as one JSON document per line.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborlight.operators.lookup import FILE_TIME
from harborlight.operators.positional import FILE_ORDER, file_order
from harborlight.sources import by_tasks

# Where API servers write their audit log by default.
DEFAULT_AUDIT_PATHS = [
    "/var/log/audit/kube/kube-apiserver.log",
    "/var/log/kube-audit/audit.log",
    "/var/log/kubernetes/audit.log",
    "/var/log/audit.log",
]

_CONTAINER_LINE = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("value", "namespace", "pod_name", "container_name")
    ]
)


def _placed(df: DataFrame) -> DataFrame:
    """Lines with the file and the split start they come from.

    Only a line feed ends a line; a carriage return before it is dropped.  Lines
    are numbered later (``operators.positional.number_lines``), because a filter
    on path keys above a numbering would no longer prune files.
    """
    line = F.col("value")
    shorter = F.substr(line, F.lit(1), F.char_length(line) - 1)
    return df.select(
        F.when(line.endswith("\r"), shorter).otherwise(line).alias("value"),
        *[F.col(c) for c in df.columns if c != "value"],
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        file_order(F.col("_metadata.file_path")).alias(FILE_ORDER),
    )


def _text(spark: SparkSession, skip_unreadable: bool = False):
    reader = spark.read.option("lineSep", "\n")
    return reader.option("ignoreCorruptFiles", "true") if skip_unreadable else reader


def scan_lines(
    spark: SparkSession, paths: str | Sequence[str], skip_unreadable: bool = False
) -> DataFrame:
    """Lines of text files with file_path and block_start.

    With ``skip_unreadable`` a file that cannot be read (any further) is left there and the
    scan goes on; :func:`files_without_lines` reports which files gave nothing.
    """
    return _placed(_text(spark, skip_unreadable).text(paths))


def scan_container_logs(
    spark: SparkSession, root: str, skip_unreadable: bool = False
) -> DataFrame:
    """Lines of landed container logs, keyed by their path; unreadable files as in scan_lines.

    Tasks list and read the files, and filters on the keys prune them.  Where Arrow cannot open
    ``root`` (or its ``.deflate`` or ``.snappy`` files), Spark's own scan lists on the driver.
    """
    lines = by_tasks.scan(spark, root, skip_unreadable)
    if lines is None:
        lines = _placed(_text(spark, skip_unreadable).schema(_CONTAINER_LINE).text(root))
    return lines


def files_without_lines(spark: SparkSession, root: str, lines: DataFrame) -> DataFrame:
    """(file_path, length) of non-empty files below ``root`` that no line of a scan comes from."""
    landed_files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .where("length > 0")
        .select(F.replace("path", F.lit("file:///"), F.lit("file:/")).alias("at"), "path", "length")
    )
    seen = lines.select(
        F.replace("file_path", F.lit("file:///"), F.lit("file:/")).alias("at")
    ).distinct()
    found = landed_files.join(seen, "at", "left_anti")
    return found.select(F.col("path").alias("file_path"), "length")


def scan_objects(spark: SparkSession, root: str) -> DataFrame:
    """Lines of landed event or object dumps, of all namespaces and kinds at once.

    ``file_time`` tells which of two dumps of one object is the newer one.
    """
    raw = spark.read.option("lineSep", "\n").text(root)
    return _placed(raw.select("value", F.col("_metadata.file_modification_time").alias(FILE_TIME)))


def stream_lines(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of files as they land."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(root)


def stream_placed_lines(
    spark: SparkSession, root: str, files_per_trigger: int | None = None
) -> DataFrame:
    """As :func:`stream_lines`, with the file and split each line comes from."""
    return _placed(stream_lines(spark, root, files_per_trigger))


def stream_container_logs(
    spark: SparkSession, root: str, files_per_trigger: int | None = None, listing: str | None = None
) -> DataFrame:
    """Lines of container logs as they land, keyed by their path.

    With ``listing``, a folder that is this stream's own as its checkpoint is, tasks list and read the
    files.  Spark's own source holds the names of all of them on the driver, at each trigger.
    """
    if listing is not None:
        lines = by_tasks.stream(spark, root, listing, files_per_trigger)
        if lines is not None:
            return lines.select(*_CONTAINER_LINE.names)
    reader = spark.readStream.schema(_CONTAINER_LINE).option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(root)


# Error condition of a file that exists but cannot be read.
_UNREADABLE = "FAILED_READ_FILE"

Candidate = Callable[[], DataFrame]


def first_non_empty(candidates: Iterable[Candidate]) -> DataFrame | None:
    """The first candidate that yields a row; later ones are not even planned.

    A candidate whose path does not exist counts as empty, and so does one that
    cannot be read, with a warning.  The probe stops at the first row found.
    """
    for candidate in candidates:
        try:
            rows = candidate()
            if not rows.isEmpty():
                return rows
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
        except Py4JJavaError as err:
            if _UNREADABLE not in str(err.java_exception):
                raise
            warnings.warn(f"unreadable input is skipped: {err.java_exception}", stacklevel=2)
    return None
