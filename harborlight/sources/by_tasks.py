"""Lines of container logs whose files tasks list and read; filters on their keys prune files.

Spark's file sources keep every file name and folder on the driver.  Here tasks list the folders,
the listing is stored by namespace, and a frame of its rows reads the files: one row per piece of a
file goes through an iterator function that gives the piece's lines as an array, which is exploded.
Unlike a mapInArrow, that lets filters on namespace, pod and container move below the reading.

A piece covers PIECE_BYTES of a plain file, and PACKED_BYTES as landed of a compressed one.  A task
gets the pieces of a compressed file one after the other and keeps its stream open between them; should
it get one out of turn, it reads the file from its start to that piece.

A stream follows a listing: a table to which every update adds the files that it lacks, some thousand to
a part.  Spark's file source sees the parts only and its checkpoint knows which were read, so every
file is read once.  While a query reads the listing, a thread updates it.  A listing has one consumer,
as a checkpoint has, and lives as long.
"""

from __future__ import annotations

import threading
import time
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from harborlight.operators.podlogs import CONTAINER
from harborlight.operators.positional import FILE_ORDER, file_order
from harborlight.operators.winners import stored
from harborlight.session import scratch_dir
from harborlight.sources import growing, manifest

#: bytes of a plain file whose lines a task holds at once
PIECE_BYTES = 2 << 20
#: the same of a compressed file, which may be many times as large when read
PACKED_BYTES = 128 << 10
_READ_BYTES = 1 << 20
#: lines of small files are handed on in batches of about so many bytes
_BATCH_BYTES = 1 << 20

#: a listing that a query reads is updated after so many seconds, or SHARE times what the last update took
PAUSE_SECONDS = 2
SHARE = 9

FILES = "file_path string, pod_name string, container_name string, length long, modified long, file_order string"
LISTED = f"{FILES}, namespace string"
# Hive's name of a missing key, and endings of files that only Hadoop can decompress.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"
_HADOOP_ONLY = (".deflate", ".snappy")
_BOM = b"\xef\xbb\xbf"


def address(spark: SparkSession, root: str) -> str | None:
    """The full address of a folder that tasks can open; None if only Spark can, or for a pattern."""
    if any(mark in root for mark in "*?[{"):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not system.exists(path):
        told = f"[PATH_NOT_FOUND] Path does not exist: {root}."
        raise AnalysisException(message=told, errorClass="PATH_NOT_FOUND")
    full = system.makeQualified(path).toString()
    try:
        found, inside = growing.opened(full)
    except (pa.ArrowException, OSError, NotImplementedError):
        return None
    return full if found.get_file_info(inside).type == pafs.FileType.Directory else None


def container_files(spark: SparkSession, full: str) -> DataFrame:
    """The files below the folder at address ``full``, with their keys and order, as LISTED."""
    found = growing.list_files(spark, full).where("NOT endswith(path, '._COPYING_')")
    inside = F.substr("path", F.lit(len(full.rstrip("/")) + 1))

    def key(name: str):
        value = F.regexp_extract(inside, f"/{name}=([^/]*)/", 1)
        plain = F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)
        lost = F.raise_error(F.concat(F.lit(f"no folder {name}=… in the path of "), "path"))
        return F.when(value == "", lost.cast("string")).when(value != _NO_KEY, plain).alias(name)

    # local files as Spark writes them
    path = F.regexp_replace("path", "^file:/+", "file:///").alias("file_path")
    namespace, *others = (key(name) for name in CONTAINER)
    return found.select(path, *others, "length", "modified", file_order(path).alias(FILE_ORDER), namespace)


def scan(spark: SparkSession, root: str, skip_unreadable: bool = False) -> DataFrame | None:
    """Lines of the files below ``root``; None where only Spark can read them."""
    full = address(spark, root)
    if full is None:
        return None
    place = scratch_dir(spark, "container-files")
    # few files on each namespace, however many tasks listed them
    container_files(spark, full).hint("rebalance", "namespace").write.partitionBy("namespace").parquet(place)
    files = spark.read.schema(LISTED).parquet(place)
    foreign = F.max(_ends(_HADOOP_ONLY))
    size, n_files, only_hadoop = files.agg(F.sum("length"), F.count(F.lit(1)), foreign).first()
    return None if only_hadoop else lines_of(files, n_tasks(spark, size, n_files), skip_unreadable)


def n_tasks(spark: SparkSession, size: int | None, n_files: int) -> int:
    """Tasks that read so many bytes of so many files."""
    return max((size or 0) // growing.TASK_BYTES + 1, growing.path_tasks(spark, n_files))


def _ends(endings):
    found = F.lit(False)
    for ending in endings:
        found = found | F.col("file_path").endswith(ending)
    return found


def lines_of(files: DataFrame, tasks: int, skip_unreadable: bool = False) -> DataFrame:
    """Lines of listed files, a frame or a stream, as ``landed`` gives them, with ``line_no``."""
    skips_missing = files.sparkSession.conf.get("spark.sql.files.ignoreMissingFiles", "false") == "true"
    read = F.arrow_udf(_reader(skip_unreadable, skips_missing), "array<struct<line_no: bigint, raw: binary>>")
    packed = _ends(manifest._CODECS)
    step = F.when(packed, F.lit(PACKED_BYTES)).otherwise(F.lit(PIECE_BYTES)).cast("long")
    lows = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0).cast("long")), step)
    pieces = files.withColumn("low", F.explode(lows))
    pieces = pieces.withColumns(
        {"high": F.least(F.col("low") + step, F.col("length")), "_at": F.when(~packed, F.col("low"))}
    ).repartition(tasks, "file_path", "_at")
    lines = pieces.select(
        *CONTAINER, "file_path", FILE_ORDER,
        F.explode(read("file_path", "low", "high", "length")).alias("line"),
    )
    text = F.col("line.raw").cast("string")
    shorter = F.substr(text, F.lit(1), F.char_length(text) - 1)
    return lines.select(
        F.when(text.endswith("\r"), shorter).otherwise(text).alias("value"),
        *CONTAINER, "file_path", F.lit(0).cast("long").alias("block_start"), FILE_ORDER,
        F.col("line.line_no").alias("line_no"),
    )


def _reader(skip_unreadable: bool, skips_missing: bool):
    """The function that gives the lines of pieces (path, low, high, length)."""

    def read(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        packed = _Packed()
        for columns in batches:
            batch, size = _Arrays(), 0
            for piece in zip(*(c.to_pylist() for c in columns), strict=True):
                try:
                    for at, lines in packed.lines(*piece) if manifest._codec(piece[0]) else _plain_lines(*piece):
                        size += batch.add(at, lines)
                except FileNotFoundError:
                    if not (skips_missing or skip_unreadable):
                        raise
                except (OSError, EOFError, zlib.error, pa.ArrowException) as failed:
                    if not skip_unreadable:
                        raise OSError(f"{piece[0]}: {type(failed).__name__}: {failed}") from failed
                batch.ends.append(len(batch.raw))
                if size >= _BATCH_BYTES:
                    yield batch.array()
                    batch, size = _Arrays(), 0
            if len(batch.ends) > 1:
                yield batch.array()

    return read


class _Arrays:
    """The lines of some pieces, an array each."""

    def __init__(self):
        self.ends, self.starts, self.raw = [0], [np.empty(0, np.int64)], []

    def add(self, at: int, lines: list[bytes]) -> int:
        """Take lines of which the first starts at ``at``; their bytes are returned."""
        self.starts.append(manifest._starts(at, lines))
        if at == 0 and lines and lines[0].startswith(_BOM):
            lines = [lines[0][len(_BOM) :], *lines[1:]]
        self.raw += lines
        return manifest._size(lines)

    def array(self) -> pa.Array:
        lines = [pa.array(np.concatenate(self.starts)), pa.array(self.raw, pa.binary())]
        lines = pa.StructArray.from_arrays(lines, ["line_no", "raw"])
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), lines)


def _plain_lines(path: str, low: int, high: int, length: int) -> Iterator[tuple[int, list[bytes]]]:
    """(start of the first, lines) of the lines that start in a piece; the last one is read to its end."""
    if path.endswith(_HADOOP_ONLY):
        raise OSError("only Hadoop can decompress this file")
    system, inside = growing.opened(path)
    with system.open_input_file(inside) as file:
        at = max(low - 1, 0)
        file.seek(at)

        def read() -> bytes:
            nonlocal at
            piece = file.read(_READ_BYTES)
            if not piece and at < length:
                raise EOFError(f"the file ends before its {length} listed bytes")
            at += len(piece)
            return piece

        for start, lines in manifest._line_blocks(read, at, high, low > 0):
            n = int(manifest._starts(start, lines).searchsorted(high))
            if n:
                yield start, lines[:n]


class _Packed:
    """The compressed file that a task reads, open from one of its pieces to the next."""

    path, done, file, blocks = None, 0, None, iter(())

    def lines(self, path: str, low: int, high: int, length: int) -> Iterator[tuple[int, list[bytes]]]:
        if path != self.path or low != self.done:
            self._open(path)
            if low:  # out of turn
                for _ in self._until(low, length):
                    pass
        self.done = high
        yield from self._until(high, length)

    def _open(self, path: str) -> None:
        if self.file:
            self.file.close()
        self.path, self.done, self.file, self.blocks = path, 0, None, iter(())
        system, inside = growing.opened(path)
        self.file = system.open_input_file(inside)
        read = manifest._plain(self.file, manifest._codec(path))
        self.blocks = manifest._line_blocks(read, 0, 1 << 62, False)

    def _until(self, high: int, length: int) -> Iterator[tuple[int, list[bytes]]]:
        """Blocks whose reading begins before the landed byte ``high``; behind the last one, all."""
        while high >= length or self.file.tell() < high:
            block = next(self.blocks, None)
            if block is None:
                return
            yield block


#: begins the name of the metric that counts the lines a trigger read
LINES = "lines by the listing"

_locks: dict[tuple[str, str], threading.Lock] = {}
_failures: dict[str, BaseException] = {}


def stream(spark: SparkSession, root: str, listing: str, files_per_trigger: int | None = None) -> DataFrame | None:
    """Lines of files as they land, by the listing at ``listing``; None where only Spark can read them."""
    full = address(spark, root)
    if full is None:
        return None
    key = (spark.sparkContext.applicationId, listing)
    followed = key in _locks
    lock = _locks.setdefault(key, threading.Lock())
    started = time.monotonic()
    with lock:
        size, n_files = update_listing(spark, full, listing, files_per_trigger)
    if not followed:
        keep = (spark, full, listing, files_per_trigger, lock, time.monotonic() - started)
        threading.Thread(target=_keep_listed, args=keep, daemon=True).start()
    # parts are few and kept for good, so none is forgotten or passed over for its age
    reader = spark.readStream.schema(LISTED).option("maxFileAge", "36500d")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", 1)
    lines = lines_of(reader.parquet(listing), n_tasks(spark, size, n_files))
    return lines.observe(f"{LINES} {listing}", F.count(F.lit(1)).alias("n"))


def update_listing(
    spark: SparkSession, full: str, listing: str, files_per_part: int | None = None
) -> tuple[int | None, int]:
    """Add the files below ``full`` that the listing lacks; their bytes and number.

    An update that dies leaves whole parts, or none, and the next one adds what is still missing.
    """
    files = container_files(spark, full)
    try:
        before = spark.read.schema(LISTED).parquet(listing)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        before = None
    else:
        files = files.join(before.select("file_path"), "file_path", "left_anti")
    fresh = stored(files, "listing-fresh")
    size, n_files = fresh.agg(F.sum("length"), F.count(F.lit(1))).first()
    if n_files or before is None:
        parts = fresh.repartition(growing.path_tasks(spark, n_files), "file_path").write.mode("append")
        # parts of a task that is repeated must not stay
        parts = parts.option("mapreduce.fileoutputcommitter.algorithm.version", "1")
        parts.option("maxRecordsPerFile", files_per_part or growing.TASK_PATHS).parquet(listing)
    return size, n_files


def _keep_listed(spark, full: str, listing: str, files_per_part: int | None, lock, took: float) -> None:
    """Update the listing while queries read it; they are stopped if that fails."""
    while True:
        time.sleep(max(PAUSE_SECONDS, SHARE * took))
        try:
            reading = [q for q in spark.streams.active if _reads(q, listing)]
        except Exception:  # noqa: BLE001
            return  # the session has ended
        if not reading:
            continue
        started = time.monotonic()
        try:
            with lock:
                update_listing(spark, full, listing, files_per_part)
        except Exception as failed:  # noqa: BLE001
            if spark.sparkContext._jsc is None:
                return
            warnings.warn(f"stopped, as files could not be listed: {failed}", stacklevel=2)
            for query in reading:
                _failures[query.id] = failed
                query.stop()
        took = time.monotonic() - started


def _reads(query: StreamingQuery, listing: str) -> bool:
    progress = query.lastProgress
    name = listing.rstrip("/").rpartition(":")[2].lstrip("/")
    return progress is not None and any(f"/{name}]" in s.description for s in progress.sources)


def rows_read(progress: StreamingQueryProgress) -> int:
    """Lines that a trigger read; the rows of a listing are files."""
    lines = [row["n"] for name, row in progress["observedMetrics"].items() if name.startswith(LINES)]
    return sum(lines) if lines else progress["numInputRows"]


def listing_failure(query: StreamingQuery) -> BaseException | None:
    """What stopped a query whose listing could not be updated."""
    return _failures.get(query.id)
