"""A manifest of landed container logs, from which scans take their files.

A scan of folders lists them on the driver, whatever it is going to read.  The manifest is kept
beside the files instead: :func:`update_manifest` lists folders by tasks, reads what is new or
changed once, and notes per file its container, length, lines, range of times and whether it
could be read to its end.  A later scan picks its files from those rows and hands them to tasks
in ranges; the driver sees no file name, and files of other containers or times are not opened.

A file is broken if reading it fails, or if fewer bytes could be read than landed.  Its
complete lines up to there count and are scanned; :func:`broken_files` reports it, and every update
reads it again.  A last line without line break is a line, but not in a broken file.

A scan gives the lines that the manifest counts or fails: a file that went, was cut or cannot be read
any more since the update is no shorter answer.

The manifest is kept twice and written in turn; a one-row table beside each turn, written last,
makes it valid, so a failed update leaves the one before.  A file counts as changed if its
length or time of modification is another; one that is gone leaves the manifest.  An empty
or missing root gives an empty manifest.  Land files closed: lines beyond the listed length are
not read before the next update.
"""

from __future__ import annotations

import bz2
import datetime as dt
import gzip
import warnings
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.functions.strict_json import evaluate_once
from harborlight.functions.text import is_blank
from harborlight.functions.times import instant
from harborlight.operators import filters, options
from harborlight.operators.podlogs import CONTAINER, line_time
from harborlight.operators.positional import FILE_ORDER, file_order
from harborlight.operators.winners import stored
from harborlight.sources.growing import container_keys, list_files, opened, together

#: bytes of a file that one row of work covers; compressed files are read as a whole
RANGE_BYTES = 64 << 20
#: landed bytes that a task is given
TASK_BYTES = 128 << 20
_READ_BYTES = 4 << 20
TURNS = 2

FILES = (
    "file_path string, namespace string, pod_name string, container_name string, length long,"
    " modified long, n_lines long, n_undated long, first_time timestamp, last_time timestamp,"
    " read_bytes long, error string"
)
# Codecs by the ending of a file name.
_CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd", ".lz4": "lz4"}
#: bytes asked of Arrow's decompressors at once: a broken stream loses the last of these pieces
_PLAIN_BYTES = 16 << 10
#: broken files that a warning or an error names
_NAMED = 5

_ID = [*CONTAINER, "file_path", FILE_ORDER]
_LINES = ", ".join(f"{c} string" for c in _ID) + ", line_no long, raw binary, read long, error string"


def _codec(path: str) -> str | None:
    return next((codec for ending, codec in _CODECS.items() if path.endswith(ending)), None)


def _plain(file, codec: str):
    """A function that gives the next decompressed bytes, up to the place where the file breaks."""
    if codec in ("gzip", "bz2"):
        stream = gzip.GzipFile(fileobj=file) if codec == "gzip" else bz2.BZ2File(file)
        return lambda: stream.read1(_READ_BYTES)
    stream = pa.CompressedInputStream(file, codec)
    return lambda: stream.read(_PLAIN_BYTES)


def _line_blocks(read, at: int, high: int, inside_line: bool) -> Iterator[tuple[int, list[bytes]]]:
    """(start of the first, lines) of the lines that start before ``high``, some megabytes at a time.

    ``read`` gives the bytes from ``at`` on and none at the end; with ``inside_line`` those up to the
    first line break belong to a line of the range before.
    """
    parts: list[bytes] = []
    ended = False
    while at < high and not ended:
        piece = read()
        ended = not piece
        if inside_line:
            end = piece.find(b"\n")
            if end < 0:
                at += len(piece)
                continue
            inside_line, at, piece = False, at + end + 1, piece[end + 1 :]
        parts.append(piece)
        if b"\n" not in piece and not ended:
            continue  # a long line: joined once, when its end is found
        *lines, rest = b"".join(parts).split(b"\n")
        parts = [rest]
        if ended and rest:
            lines.append(rest)
        if lines:
            yield at, lines
            at += sum(map(len, lines)) + len(lines)


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return together(_read_ranges(batches))


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of ranges (…, low, high, length), and per range one row with bytes read and error."""
    names = [*_ID, "line_no", "raw", "read", "error"]
    for batch in batches:
        for row in batch.to_pylist():

            def rows(starts, lines, read=None, error=None, row=row):
                n = len(lines)
                arrays = [pa.array([row[c]] * n, pa.string()) for c in _ID]
                arrays += [pa.array(starts, pa.int64()), pa.array(lines, pa.binary())]
                arrays += [pa.array([read] * n, pa.int64()), pa.array([error] * n, pa.string())]
                return pa.RecordBatch.from_arrays(arrays, names)

            read, n_lines, error = 0, 0, None
            try:
                for starts, lines, n_read in _range_of(row):
                    n_lines += len(lines)
                    if len(lines):
                        yield rows(starts, lines)
                    read = n_read
            except (OSError, EOFError, zlib.error, pa.ArrowException) as failed:
                error = f"{type(failed).__name__}: {failed}"[:500]
            if row["noted_lines"] is not None:
                _as_noted(row, n_lines, error)
            yield rows([None], [None], read, error)


def _as_noted(row: dict, n_lines: int, error: str | None) -> None:
    """Fail unless a range gave what the manifest notes of its file; a broken file may give more."""
    noted, broken = row["noted_lines"], row["noted_error"] is not None
    if row["low"] == 0 and row["high"] == row["length"]:  # the whole file
        same = n_lines >= noted if broken else error is None and n_lines == noted
    else:
        same = error is None or error == row["noted_error"]
    if not same:
        found = error or f"{n_lines} of {noted} listed lines read"
        raise RuntimeError(f"{row['file_path']} is not as listed, update the manifest: {found}")


def _range_of(row: dict) -> Iterator[tuple[np.ndarray, list[bytes], int]]:
    """(starts, lines, landed bytes read so far) of one range."""
    system, inside = opened(row["file_path"])
    codec, low, high, length = _codec(row["file_path"]), row["low"], row["high"], row["length"]
    with system.open_input_file(inside) as file:
        if codec:
            for at, lines in _line_blocks(_plain(file, codec), 0, 1 << 62, False):
                yield _starts(at, lines), lines, 0
            # without an error the file was read to its end
            yield np.empty(0, np.int64), [], length
            return
        begin = max(low - 1, 0)
        file.seek(begin)
        left = length - begin

        def read() -> bytes:
            nonlocal left
            piece = file.read(min(_READ_BYTES, left))
            if not piece and left > 0:
                raise EOFError(f"the file ends before its {length} listed bytes")
            left -= len(piece)
            return piece

        total = 0
        for at, lines in _line_blocks(read, begin, high, low > 0):
            starts = _starts(at, lines)
            n = int(np.searchsorted(starts, high))
            total += _size(lines[:n])
            if n and starts[0] + _size(lines[:n]) > length:
                total -= 1  # the last line of the file lacks its line break
            yield starts[:n], lines[:n], total


def _size(lines: list[bytes]) -> int:
    return sum(map(len, lines)) + len(lines)


def _starts(at: int, lines: list[bytes]) -> np.ndarray:
    sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
    return at + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if lines else np.empty(0, np.int64)


def _read(files: DataFrame, noted: bool = False) -> DataFrame:
    """Lines and closing rows of ``files``, in ranges that are spread over tasks by bytes.

    With ``noted`` they are rows of the manifest, and a range that gives other lines fails.
    """
    landed_bytes, n_files = files.agg(F.sum("length"), F.count(F.lit(1))).first()
    slots = files.sparkSession.sparkContext.defaultParallelism
    n_tasks = max((landed_bytes or 0) // TASK_BYTES + 1, min(n_files, slots))
    whole = F.lit(False)
    for ending in _CODECS:
        whole = whole | F.col("file_path").endswith(ending)
    step = F.lit(RANGE_BYTES)
    lows = F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), step.cast("long"))
    )
    ranges = files.select(
        *CONTAINER, "file_path", file_order(F.col("file_path")).alias(FILE_ORDER), "length",
        (F.col("n_lines") if noted else F.lit(None).cast("long")).alias("noted_lines"),
        (F.col("error") if noted else F.lit(None).cast("string")).alias("noted_error"),
        F.explode(lows).alias("low"),
    )
    ranges = ranges.withColumn(
        "high", F.when(whole, F.col("length")).otherwise(F.least(F.col("low") + step, F.col("length")))
    )
    return ranges.repartition(n_tasks, "file_path", "low").mapInArrow(_read_files, _LINES)


def update_manifest(spark: SparkSession, root: str, path: str) -> DataFrame:
    """Bring the manifest at ``path`` up to the files below ``root`` and return it."""
    turn, before = _last(spark, path)
    listed = container_keys(
        list_files(spark, root).select(F.col("path").alias("file_path"), "length", "modified")
    )
    same = ["file_path", "length", "modified"]
    # what broke may have been the network or a right: such files are read again
    whole = before.where("error IS NULL")
    kept = whole.join(listed.select(*same), same, "left_semi")
    fresh = stored(listed.join(whole.select(*same), same, "left_anti"), "manifest-fresh")
    text = F.col("raw").cast("string")
    timed = evaluate_once(_read(fresh), time=line_time(text))
    is_line = F.col("raw").isNotNull()
    undated = is_line & F.col("time").isNull() & ~is_blank(text)
    narrow = timed.select(
        "file_path", "error", "time", "read",
        is_line.cast("long").alias("line"), undated.cast("long").alias("undated"),
    )
    # numbers by hash first; the greatest of texts, which Spark sorts for, over a row or two per file
    parts = narrow.groupBy("file_path", "error").agg(
        F.sum("line").alias("line"),
        F.sum("undated").alias("undated"),
        F.min("time").alias("first"),
        F.max("time").alias("last"),
        F.sum("read").alias("read"),
    )
    facts = parts.groupBy("file_path").agg(
        F.sum("line").alias("n_lines"),
        F.sum("undated").alias("n_undated"),
        F.min("first").alias("first_time"),
        F.max("last").alias("last_time"),
        F.sum("read").alias("read_bytes"),
        F.max("error").alias("error"),
    )
    names = [part.split()[0] for part in FILES.split(", ")]
    short = F.concat(F.col("read_bytes"), F.lit(" of "), F.col("length"), F.lit(" bytes read"))
    found = fresh.join(facts, "file_path").withColumn(
        "error", F.coalesce("error", F.when(F.col("read_bytes") < F.col("length"), short))
    )
    now = turn + 1
    place = f"{path}/turn={now % TURNS}"
    kept.unionByName(found.select(*names)).write.mode("overwrite").parquet(f"{place}/files")
    head = spark.createDataFrame([(now,)], "turn long").coalesce(1)
    head.write.mode("overwrite").parquet(f"{place}/head")
    return read_manifest(spark, path)


def _last(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Number of the last finished update (-1: none) and its files."""
    last = -1
    for turn in range(TURNS):
        try:
            head = spark.read.schema("turn long").parquet(f"{path}/turn={turn}/head").first()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        last = max(last, head[0] if head else -1)
    if last < 0:
        return last, spark.createDataFrame([], FILES)
    return last, spark.read.schema(FILES).parquet(f"{path}/turn={last % TURNS}/files")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files as of the last finished update."""
    return _last(spark, path)[1]


def broken_files(manifest: DataFrame) -> DataFrame:
    """Files that could not be read to their end: what landed, what was read, and why."""
    return manifest.where("error IS NOT NULL").select(
        *CONTAINER, "file_path", "length", "read_bytes", "n_lines", "error"
    )


def choose_files(
    manifest: DataFrame,
    *,
    namespaces: Sequence[str] | str = (),
    pod_name_pattern: str | None = None,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """Files that can hold lines of these pods and times; undated lines pass any range.

    Nobody knows what the unread part of a broken file holds, so it passes too.
    """
    broken = F.col("error").isNotNull()
    chosen = filters.in_namespaces(manifest.where((F.col("n_lines") > 0) | broken), options.namespace_list(namespaces))
    chosen = filters.search(chosen, "pod_name", options.pattern("pod_name_pattern", pod_name_pattern))
    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col("last_time") >= instant(since))
    if until is not None:
        inside = inside & (F.col("first_time") <= instant(until))
    return chosen.where((F.col("n_undated") > 0) | broken | F.coalesce(inside, F.lit(False)))


def scan_files(files: DataFrame, keep_broken: bool = True) -> DataFrame:
    """Lines of manifest rows, with the columns that ``operators.podlogs.pod_logs`` wants.

    The scan fails if a file does not give the lines listed.  Files listed as broken give theirs up to
    the break, with a warning; without ``keep_broken`` they are refused.

    Files left out by ``since`` or ``until`` are missing before a tail or a byte budget is
    taken too: choose by time only where neither is asked for.
    """
    broken = broken_files(files).orderBy("file_path")
    some = broken.select("file_path", "error").take(_NAMED)
    if some:
        named = "; ".join(f"{r.file_path} ({r.error})" for r in some)
        told = f"{broken.count()} listed files could not be read to their end: {named}"
        if not keep_broken:
            raise RuntimeError(told)
        warnings.warn(told, stacklevel=2)
    text = F.col("raw").cast("string")
    shorter = F.substr(text, F.lit(1), F.char_length(text) - 1)
    return _read(files, noted=True).where(F.col("raw").isNotNull()).select(
        F.when(text.endswith("\r"), shorter).otherwise(text).alias("value"),
        *CONTAINER, "file_path", F.lit(0).cast("long").alias("block_start"), FILE_ORDER, "line_no",
    )
