"""Lines appended to files: append, truncate, rotate, restart."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from harborlight.operators import podlogs
from harborlight.sources import growing


@pytest.fixture
def follow(spark, tmp_path):
    """Runs once and returns the lines that run delivered, by file name."""
    root = tmp_path / "in"
    root.mkdir()
    state, out = str(tmp_path / "state"), str(tmp_path / "out")

    def run(**kw):
        before = growing._ledger(spark, state)[0]
        growing.follow_to_table(spark, str(root), state, out)
        rows = spark.read.parquet(f"{out}/run={before + 1}").collect()
        return sorted((os.path.basename(r.file_path), r.line_no, r.value) for r in rows)

    run.root, run.state, run.out = root, state, out
    return run


def test_append_truncate_and_rotate(follow):
    log = follow.root / "0.log"
    log.write_bytes(b"one\ntwo\nhal")
    assert follow() == [("0.log", 0, "one"), ("0.log", 4, "two")]
    assert follow() == []
    with log.open("ab") as f:
        f.write(b"f\r\n\xc3\xa9\n")
    assert follow() == [("0.log", 8, "half"), ("0.log", 14, "é")]
    # renamed with a line that was not read yet, and a new file under the old name
    with log.open("ab") as f:
        f.write(b"last\n")
    log.rename(follow.root / "0.log.20240101-000000")
    log.write_bytes(b"new\n")
    assert follow() == [("0.log", 0, "new"), ("0.log.20240101-000000", 17, "last")]
    # copied away and truncated
    with log.open("ab") as f:
        f.write(b"more\n")
    shutil.copy(log, follow.root / "0.log.1")
    log.write_bytes(b"third\n")
    assert follow() == [("0.log", 0, "third"), ("0.log.1", 4, "more")]
    # written anew with the same first line, and longer than what was read
    with log.open("ab") as f:
        f.write(b"x\n")
    assert follow() == [("0.log", 6, "x")]
    log.write_bytes(b"third\nanother\nlonger\n")
    assert follow() == [("0.log", 0, "third"), ("0.log", 6, "another"), ("0.log", 14, "longer")]
    # a copy beside the original is the same file
    shutil.copy(log, follow.root / "copy.log")
    with log.open("ab") as f:
        f.write(b"fourth\n")
    assert follow() == [("0.log", 21, "fourth")]


def test_run_that_dies_is_repeated(spark, follow, monkeypatch):
    (follow.root / "a.log").write_text("x1\nx2\n")
    assert len(follow()) == 2
    with (follow.root / "a.log").open("a") as f:
        f.write("x3\n")

    def dies(*args):
        raise RuntimeError("lost")

    real = growing._write_ledger
    monkeypatch.setattr(growing, "_write_ledger", dies)
    with pytest.raises(RuntimeError, match="lost"):
        follow()
    shown = growing.followed_table(spark, follow.state, follow.out)
    assert sorted(r.value for r in shown.collect()) == ["x1", "x2"]
    monkeypatch.setattr(growing, "_write_ledger", real)
    with (follow.root / "a.log").open("a") as f:
        f.write("x4\n")  # grew between the attempts
    assert [v for _, _, v in follow()] == ["x3", "x4"]
    shown = growing.followed_table(spark, follow.state, follow.out)
    assert sorted(r.value for r in shown.collect()) == ["x1", "x2", "x3", "x4"]


@pytest.mark.parametrize("size", [1, 3, 7, 50])
def test_ranges_and_reads_of_any_size(monkeypatch, tmp_path, size):
    """Every complete line is read once, wherever ranges and reads end."""
    import pyarrow as pa

    monkeypatch.setattr(growing, "_READ_BYTES", size)
    texts = [b"", b"a", b"bb", b"", b"c" * 9, b"dddd", b"e" * 23, b""]
    path = tmp_path / "f.log"
    path.write_bytes(b"\n".join(texts) + b"\nunfinished")
    length = path.stat().st_size
    for step in (1, 2, 5, 11, 100):
        found = []
        for low in range(0, length, step):
            row = dict(path=str(path), folder="", print="", first=0, low=low, high=min(low + step, length), length=length)
            batch = pa.RecordBatch.from_pylist([row])
            for got in growing._lines(iter([batch])):
                found += zip(got.column("at").to_pylist(), got.column("next").to_pylist(), got.column("raw").to_pylist())
        want, at = [], 0
        for text in texts:
            want.append((at, at + len(text) + 1, text))
            at += len(text) + 1
        assert sorted(found) == want, (size, step)


def test_containers_are_listed_by_tasks(spark, follow):
    for pod in ("p", "q+r"):
        folder = follow.root / "namespace=default" / f"pod_name={pod}" / "container_name=app"
        folder.mkdir(parents=True)
        (folder / "0.log").write_text(f"2024-01-01T00:00:00.000000000Z level=error {pod}\nno newline yet")
        (folder / ".hidden").write_text("x\n")
    (follow.root / "empty.log").write_text("")
    names = {os.path.basename(r.path) for r in growing.list_files(spark, str(follow.root)).collect()}
    assert names == {"0.log", "empty.log"}
    assert len(follow()) == 2
    keyed = growing.container_keys(growing.followed_table(spark, follow.state, follow.out))
    parsed = podlogs.parse_timestamps(keyed).select("pod_name", "log_message", F.year("timestamp"))
    assert sorted(tuple(r) for r in parsed.collect()) == [
        ("p", "level=error p", 2024), ("q+r", "level=error q+r", 2024),
    ]


def test_vanished_files_are_forgotten(spark, follow):
    for name in ("a.log", "b.log"):
        (follow.root / name).write_text(f"{name}\n")
    follow()
    (follow.root / "a.log").unlink()
    for left in (2, 1):  # kept for one run, in case it was only being moved
        follow()
        assert growing._ledger(spark, follow.state)[1].count() == left


def test_nothing_there(spark, tmp_path):
    delivered = []
    n = growing.follow_growing(spark, str(tmp_path / "no"), str(tmp_path / "s"), lambda d, run: delivered.append(d.count()))
    assert n == 0 and delivered == [0]
