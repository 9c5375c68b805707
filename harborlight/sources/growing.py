"""Lines appended to files that are still written, each delivered once.

File streams read a file once.  Here a run reads what was appended since the last one:

1. Folders are listed by tasks, one level after the other; the driver sees no file name.
2. A file is known by its folder and a fingerprint of its first line, which never changes while
   it grows, and the last line read must still stand where it stood.  A renamed file keeps its
   fingerprint and goes on where it was; a truncated or new file under the old name fails one
   of the two and starts at 0.  Of several files with one fingerprint in a folder (a copy
   next to the original) one is read.
3. The ledger holds, per file, the bytes read so far.  Tasks read the ranges between it and the
   listed length, large ones in pieces, and only lines that are complete.
4. The lines are stored and handed to the sink under the number of the run; then the ledger of
   that run is written.  A run that dies before that is repeated under the same number, and
   its output is written over: every line is delivered once.

The ledger is kept twice and written in turn.  A file that two runs in a row did not find is
forgotten.  Files are read through Arrow's file systems (local or mounted folders, HDFS,
object stores).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborlight.operators.positional import FILE_ORDER, file_order
from harborlight.operators.winners import stored

#: bytes of the first line that make the fingerprint
HEAD_BYTES = 4096
#: a long tail is read in ranges of so many bytes, by different tasks
RANGE_BYTES = 64 << 20
#: bytes that a task is given
TASK_BYTES = 128 << 20
#: bytes a task reads, and lines it holds, at once
_READ_BYTES = 4 << 20
#: paths that a task lists or opens
TASK_PATHS = 4_000
#: lines of small files are handed on in batches of about so many bytes
_BATCH_BYTES = 1 << 20
TURNS = 2

_FILES = "path string, folder string, length long, modified long"
_LEDGER = (
    "run long, folder string, print string, path string, length long, modified long,"
    " last_at long, last_print string, missed int"
)


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path inside it; ``file:/x`` is written ``file:///x``.

    As in Spark, names in an address are written as they are; Arrow would decode a ``%41``.
    """
    scheme, colon, rest = path.partition(":")
    if colon and "/" not in scheme:
        rest = rest if rest.startswith("//") else f"//{rest}"
        path = f"{scheme}:{quote(rest, safe='/:@?&=+,')}"
    return pafs.FileSystem.from_uri(path)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # most folders hold one entry, and a batch costs more than listing it
    return together(_below(batches))


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of the folders, as (path, folder, length, modified); a folder has no length."""
    schema = pa.schema([("path", pa.string()), ("folder", pa.string()), ("length", pa.int64()), ("modified", pa.int64())])
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, inside = opened(folder)
            rows = []
            for found in system.get_file_info(pafs.FileSelector(inside, allow_not_found=True)):
                if found.base_name.startswith((".", "_")):
                    continue
                is_file = found.type == pafs.FileType.File
                changed = int(found.mtime_ns or 0)
                rows.append((f"{folder.rstrip('/')}/{found.base_name}", folder, found.size if is_file else None, changed))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def list_files(spark: SparkSession, root: str, levels: int = 16) -> DataFrame:
    """(path, folder, length, modified) of all files below ``root``, listed by tasks."""
    folders = spark.createDataFrame([(root.rstrip("/"),)], "path string")
    files = None
    n_folders = 1
    for _ in range(levels):
        spread = folders.repartition(path_tasks(spark, n_folders), "path")
        found = stored(spread.mapInArrow(_entries, _FILES), "listing")
        mine = found.where("length is not null")
        files = mine if files is None else files.unionByName(mine)
        folders = found.where("length is null").select("path")
        n_folders = folders.count()
        if not n_folders:
            break
    return files


def path_tasks(spark: SparkSession, n_paths: int) -> int:
    """Tasks that open or list ``n_paths`` paths.

    The number is fixed: rows of paths are tiny, and AQE would put all of them into one task.
    """
    return max(1, min(n_paths, max(spark.sparkContext.defaultParallelism, n_paths // TASK_PATHS + 1)))


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, those of many small files in one batch; a large batch stays as it is."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= _BATCH_BYTES:
            yield from _joined(held)
            held, size = [], 0
    yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(held).combine_chunks().to_batches() if held else []


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the fingerprint; none while the first line is not complete, or for a vanished file."""
    for batch in batches:
        prints = []
        for path in batch.column("path").to_pylist():
            system, inside = opened(path)
            try:
                with system.open_input_file(inside) as file:
                    head = file.read(HEAD_BYTES)
            except FileNotFoundError:
                head = b""
            end = head.find(b"\n")
            complete = end >= 0 or len(head) == HEAD_BYTES
            prints.append(hashlib.md5(head[: end if end >= 0 else HEAD_BYTES]).hexdigest() if complete else None)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, "print"])


def _still_there(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds whether the last line that was read stands where it stood."""
    for batch in batches:
        same = []
        for row in batch.select(["path", "read", "last_at", "last_print"]).to_pylist():
            system, inside = opened(row["path"])
            with system.open_input_file(inside) as file:
                file.seek(row["last_at"])
                line = file.read(row["read"] - row["last_at"])
            same.append(hashlib.md5(line[:-1]).hexdigest() == row["last_print"])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same, pa.bool_())], [*batch.schema.names, "same"])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return together(_lines_of_ranges(batches))


def _lines_of_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Complete lines that start inside the ranges (path, folder, print, first, low, high, length)."""
    names = ["folder", "print", "path", "at", "next", "raw"]
    for batch in batches:
        for row in batch.to_pylist():
            system, inside = opened(row["path"])
            with system.open_input_file(inside) as file:
                at = row["low"]
                if at > row["first"]:  # the line that reaches into this range belongs to the one before
                    file.seek(at - 1)
                    at -= 1
                    while at < row["length"]:
                        piece = file.read(min(_READ_BYTES, row["length"] - at))
                        end = piece.find(b"\n")
                        if end >= 0 or not piece:
                            at += end + 1
                            break
                        at += len(piece)
                    else:
                        continue
                file.seek(at)
                kept, rest, position = [], b"", at
                while position < row["high"] or rest:
                    piece = file.read(min(_READ_BYTES, row["length"] - position - len(rest)))
                    if not piece:
                        break
                    *whole, rest = (rest + piece).split(b"\n")
                    for line in whole:
                        if position >= row["high"]:
                            rest = b""
                            break
                        kept.append((position, position + len(line) + 1, line))
                        position += len(line) + 1
                    if position >= row["high"]:
                        rest = b""
                    if kept:
                        yield _placed_lines(names, row, kept)
                        kept = []
                    if not rest and position >= row["high"]:
                        break


def _placed_lines(names: list[str], row: dict, kept: list[tuple]) -> pa.RecordBatch:
    n = len(kept)
    where = [pa.array([row[c]] * n, pa.string()) for c in ("folder", "print", "path")]
    at, following, raw = zip(*kept, strict=True)
    arrays = [*where, pa.array(at, pa.int64()), pa.array(following, pa.int64()), pa.array(raw, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names)


def _ledger(spark: SparkSession, state: str) -> tuple[int, DataFrame]:
    """Number of the last finished run (-1: none) and its ledger."""
    last, ledger = -1, spark.createDataFrame([], _LEDGER)
    for turn in range(TURNS):
        try:
            kept = spark.read.schema(_LEDGER).parquet(f"{state}/ledger/turn={turn}")
            run = kept.agg(F.max("run")).first()[0]
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if run is not None and run > last:
            last, ledger = run, kept.where(F.col("path").isNotNull())
    return last, ledger


def _known_files(spark: SparkSession, root: str, ledger: DataFrame) -> DataFrame:
    """Listed files with fingerprint; those as long and old as in the ledger are not opened."""
    listed = list_files(spark, root)
    same = ledger.select("path", "modified", F.col("print").alias("old_print"), F.col("length").alias("read"))
    met = listed.join(same, ["path", "modified"], "left")
    unchanged = F.col("old_print").isNotNull() & (F.col("read") == F.col("length"))
    columns = ["path", "folder", "length", "modified"]
    opened = met.where(~unchanged | F.col("old_print").isNull()).select(*columns)
    opened = opened.repartition(path_tasks(spark, opened.count()), "path")
    opened = opened.mapInArrow(_fingerprints, f"{_FILES}, print string")
    kept = met.where(unchanged).select(*columns, F.col("old_print").alias("print"))
    return stored(opened.unionByName(kept).where(F.col("print").isNotNull()), "growing-files")


def _work(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per fingerprint: where it is now, and what of it was read."""
    before = ledger.select(
        "folder", "print", F.col("path").alias("old_path"), F.col("length").alias("read"), "last_at", "last_print"
    )
    met = files.join(before, ["folder", "print"], "left")
    best = Window.partitionBy("folder", "print").orderBy(
        F.coalesce(F.col("path") == F.col("old_path"), F.lit(False)).desc(), F.desc("length"), "path"
    )
    one = met.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "old_path")
    # a file that is shorter than what was read, under the same first line, was written anew
    one = stored(one, "growing-found")
    grown = F.coalesce((F.col("length") > F.col("read")) & (F.col("read") > 0), F.lit(False))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in one.schema)
    again = one.where(grown)
    again = again.repartition(path_tasks(one.sparkSession, again.count()), "path")
    compared = again.mapInArrow(_still_there, f"{schema}, same boolean")
    equal = F.coalesce(F.col("length") == F.col("read"), F.lit(False))
    work = compared.unionByName(one.where(~grown).withColumn("same", equal))
    return work.withColumn("first", F.when(F.col("same"), F.col("read")).otherwise(F.lit(0)))


def follow_growing(
    spark: SparkSession, root: str, state: str, deliver: Callable[[DataFrame, int], None]
) -> int:
    """One run: hand the lines appended since the last run to ``deliver``; their number is returned.

    ``deliver`` gets lines with ``value``, ``file_path``, ``file_order`` and ``line_no`` (the line's
    byte in its file) and the number of the run, under which it must write, replacing what a
    failed attempt of the same run left.
    """
    last, ledger = _ledger(spark, state)
    run = last + 1
    work = stored(_work(_known_files(spark, root, ledger), ledger), "growing-work")
    step = F.lit(RANGE_BYTES)
    ranges = work.where(F.col("length") > F.col("first")).select(
        "path", "folder", "print", "first", "length",
        F.explode(F.sequence(F.col("first"), F.col("length") - 1, step)).alias("low"),
    ).withColumn("high", F.least(F.col("low") + step, F.col("length")))
    lines = "folder string, print string, path string, at long, next long, raw binary"
    # rows of ranges are tiny, so left to itself AQE would put gigabytes of files into one task
    n_files, to_read = work.agg(F.count(F.lit(1)), F.sum(F.col("length") - F.col("first"))).first()
    slots = spark.sparkContext.defaultParallelism
    n_tasks = max((to_read or 0) // TASK_BYTES + 1, min(n_files, slots))
    read = stored(ranges.repartition(n_tasks, "path", "low").mapInArrow(_lines, lines), "growing-lines")
    text = F.col("raw").cast("string")
    shorter = F.substr(text, F.lit(1), F.char_length(text) - 1)
    deliver(
        read.select(
            F.when(text.endswith("\r"), shorter).otherwise(text).alias("value"),
            F.col("path").alias("file_path"),
            file_order(F.col("path")).alias(FILE_ORDER),
            F.col("at").alias("line_no"),
        ),
        run,
    )
    _write_ledger(spark, state, run, ledger, work, read)
    return read.count()


def _write_ledger(spark, state: str, run: int, ledger: DataFrame, work: DataFrame, read: DataFrame) -> None:
    name = ["folder", "print"]
    ends = read.groupBy(*name).agg(F.max("next").alias("end"))
    at_end = read.select(*name, F.col("next").alias("end"), F.col("at").alias("new_at"), F.md5("raw").alias("new_print"))
    seen = work.join(ends.join(at_end, [*name, "end"]), name, "left")
    number, none_read = F.lit(run).cast("long").alias("run"), F.col("end").isNull()
    seen = seen.select(
        number, *name, "path", F.coalesce("end", "first").alias("length"), "modified",
        F.when(none_read, F.col("last_at")).otherwise(F.col("new_at")).alias("last_at"),
        F.when(none_read, F.col("last_print")).otherwise(F.col("new_print")).alias("last_print"),
        F.lit(0).alias("missed"),
    )
    gone = ledger.join(work.select(*name), name, "left_anti").where("missed = 0")
    gone = gone.withColumns({"run": number, "missed": F.lit(1)})
    # a row without a path keeps the number of a run that knows no file
    none = spark.createDataFrame([(run, *[None] * 8)], _LEDGER)
    rows = stored(seen.unionByName(gone).unionByName(none), "growing-ledger")
    rows.write.mode("overwrite").parquet(f"{state}/ledger/turn={run % TURNS}")


def container_keys(lines: DataFrame) -> DataFrame:
    """Adds the container keys that the path names, so that lines can be used as scanned ones."""

    def key(name: str) -> Column:
        found = F.regexp_extract("file_path", f"/{name}=([^/]*)/", 1)
        return F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B")))

    return lines.withColumns({c: key(c) for c in ("namespace", "pod_name", "container_name")})


def follow_to_table(
    spark: SparkSession,
    root: str,
    state: str,
    path: str,
    rows: Callable[[DataFrame], DataFrame] = lambda lines: lines,
) -> int:
    """One run that writes ``rows`` of the new lines below ``path/run=<n>``."""

    def write(lines: DataFrame, run: int) -> None:
        rows(lines).write.mode("overwrite").parquet(f"{path}/run={run}")

    return follow_growing(spark, root, state, write)


def followed_table(spark: SparkSession, state: str, path: str) -> DataFrame:
    """What finished runs delivered; an unfinished run is not shown."""
    last, _ = _ledger(spark, state)
    return spark.read.parquet(path).where(F.col("run") <= last).drop("run")
