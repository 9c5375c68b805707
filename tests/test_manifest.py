from __future__ import annotations

import datetime as dt
import gzip
import os

import pytest

from harborlight.operators import podlogs
from harborlight.sources import growing, manifest


def line(day: int, text: str) -> str:
    return f"2024-01-{day:02d}T00:00:00.000000000Z {text}\n"


def folder_of(root, namespace="a", pod="p", container="app"):
    folder = root / f"namespace={namespace}" / f"pod_name={pod}" / f"container_name={container}"
    folder.mkdir(parents=True, exist_ok=True)
    return folder


def facts(found):
    columns = ("namespace", "n_lines", "n_undated", "read_bytes", "error")
    return {r.file_path.rsplit("/", 1)[1]: tuple(r[c] for c in columns) for r in found.collect()}


@pytest.fixture
def place(tmp_path):
    return tmp_path / "logs", str(tmp_path / "manifest")


def test_files_and_their_facts(spark, place):
    root, at = place
    folder = folder_of(root)
    dated = line(1, "x") + line(3, "y")
    (folder / "0.log").write_text(dated + "plain\n \n")
    (folder / "1.log").write_text(dated + "no line break")
    (folder / "2.log").write_text("")
    (folder_of(root, "b") / "3.log.gz").write_bytes(gzip.compress(dated.encode()) + gzip.compress(b"more\n"))
    found = manifest.update_manifest(spark, str(root), at)
    size = (folder / "0.log").stat().st_size
    assert facts(found) == {
        "0.log": ("a", 4, 1, size, None),
        "1.log": ("a", 3, 1, (folder / "1.log").stat().st_size, None),
        "2.log": ("a", 0, 0, 0, None),
        "3.log.gz": ("b", 3, 1, (folder_of(root, "b") / "3.log.gz").stat().st_size, None),
    }
    first = found.where("n_lines = 4").first()
    assert (first.first_time.day, first.last_time.day) == (1, 3)
    rows = manifest.scan_files(found).orderBy("file_order", "line_no").collect()
    assert [r.value.split()[-1] if r.value.strip() else r.value for r in rows] == [
        "x", "y", "plain", " ", "x", "y", "break", "x", "y", "more",
    ]


def test_a_file_broken_half_way_is_reported_and_its_lines_are_kept(spark, place):
    root, at = place
    folder = folder_of(root)
    whole = gzip.compress("".join(line(1 + i % 20, f"{i * 7919 % 10007}") for i in range(50_000)).encode())
    (folder / "0.log.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "1.log.gz").write_bytes(whole)
    (folder / "2.log.gz").write_bytes(b"no gzip at all")
    found = manifest.update_manifest(spark, str(root), at)
    broken = {r.file_path[-8:]: r for r in manifest.broken_files(found).collect()}
    assert set(broken) == {"0.log.gz", "2.log.gz"}
    assert 0 < broken["0.log.gz"].n_lines < 50_000 and broken["2.log.gz"].n_lines == 0
    lines = manifest.scan_files(found).groupBy("file_path").count().collect()
    assert {r.file_path[-8:]: r["count"] for r in lines} == {
        "0.log.gz": broken["0.log.gz"].n_lines,
        "1.log.gz": 50_000,
    }


@pytest.mark.parametrize("range_bytes, read_bytes", [(1, 3), (7, 2), (64, 5), (1000, 1000)])
def test_ranges_give_each_line_once(spark, place, monkeypatch, range_bytes, read_bytes):
    root, _ = place
    file = folder_of(root) / "0.log"
    lines = ["", "a", "bb" * 40, "", "c", "", "dd", "e" * 9]
    for text in ("\n".join(lines), "\n".join(lines) + "\n", "\n\n\n", "x"):
        file.write_bytes(text.encode())
        length = len(text)
        monkeypatch.setattr(manifest, "_READ_BYTES", read_bytes)
        got, read = [], 0
        for low in range(0, length, range_bytes):
            row = {"file_path": str(file), "low": low, "high": min(low + range_bytes, length), "length": length}
            n = 0
            for starts, some, n in manifest._range_of(row):
                got += zip(starts.tolist(), some, strict=True)
            read += n
        expected, at = [], 0
        for part in text.encode().removesuffix(b"\n").split(b"\n"):
            expected.append((at, part))
            at += len(part) + 1
        assert got == expected and read == length


def test_only_new_and_changed_files_are_read_again(spark, place, monkeypatch):
    root, at = place
    folder = folder_of(root)
    (folder / "0.log").write_text(line(1, "x"))
    (folder / "1.log").write_text(line(1, "x"))
    (folder / "2.log").write_text(line(1, "x"))
    manifest.update_manifest(spark, str(root), at)
    (folder / "1.log").write_text(line(1, "x") + line(2, "y"))
    (folder / "2.log").unlink()
    (folder / "3.log").write_text(line(9, "z"))
    asked = []
    read = manifest._read
    monkeypatch.setattr(manifest, "_read", lambda files: asked.extend(files.collect()) or read(files))
    found = manifest.update_manifest(spark, str(root), at)
    assert sorted(r.file_path[-5:] for r in asked) == ["1.log", "3.log"]
    assert {k: v[1] for k, v in facts(found).items()} == {"0.log": 1, "1.log": 2, "3.log": 1}


def test_a_failed_update_leaves_the_one_before(spark, place, monkeypatch):
    root, at = place
    folder = folder_of(root)
    for i in range(3):
        (folder / f"{i}.log").write_text(line(1, "x"))
        manifest.update_manifest(spark, str(root), at)
    (folder / "3.log").write_text(line(1, "x"))
    create = spark.createDataFrame

    def fails(rows, schema):
        if schema == "turn long":
            raise RuntimeError("lost before the head was written")
        return create(rows, schema)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, rows, schema: fails(rows, schema))
    with pytest.raises(RuntimeError):
        manifest.update_manifest(spark, str(root), at)
    monkeypatch.undo()
    assert set(facts(manifest.read_manifest(spark, at))) == {"0.log", "1.log", "2.log"}
    assert len(facts(manifest.update_manifest(spark, str(root), at))) == 4


def test_choice_by_pod_and_time(spark, place):
    root, at = place
    (folder_of(root, "a", "web-1") / "old.log").write_text(line(1, "x") + line(4, "x"))
    (folder_of(root, "a", "db-1") / "new.log").write_text(line(8, "x"))
    (folder_of(root, "b", "web-2") / "mixed.log").write_text(line(1, "x") + "undated\n")
    (folder_of(root, "b", "web-3") / "empty.log").write_text("")
    found = manifest.update_manifest(spark, str(root), at)

    def chosen(**how):
        return sorted(r.file_path.rsplit("/", 1)[1] for r in manifest.choose_files(found, **how).collect())

    assert chosen() == ["mixed.log", "new.log", "old.log"]
    assert chosen(namespaces="a") == ["new.log", "old.log"]
    assert chosen(pod_name_pattern="^web") == ["mixed.log", "old.log"]
    assert chosen(since=dt.datetime(2024, 1, 4)) == ["mixed.log", "new.log", "old.log"]
    assert chosen(since=dt.datetime(2024, 1, 5)) == ["mixed.log", "new.log"]
    assert chosen(until=dt.datetime(2023, 12, 31)) == ["mixed.log"]
    with pytest.raises(ValueError):
        chosen(pod_name_pattern="(")


def test_an_unknown_root_is_an_empty_manifest(spark, place):
    root, at = place
    found = manifest.update_manifest(spark, str(root), at)
    assert found.count() == 0 and manifest.scan_files(found).count() == 0


def test_the_driver_lists_nothing(spark, place):
    root, at = place
    (folder_of(root) / "0.log").write_text(line(1, "x") + "y\r\n")
    found = manifest.update_manifest(spark, str(root), at)
    lines = manifest.scan_files(manifest.choose_files(found))
    assert not any("container_name=" in f for f in lines.inputFiles())
    parsed = podlogs.parse_timestamps(lines)
    assert sorted(r.log_message for r in parsed.collect()) == ["x", "y"]
    assert growing.list_files(spark, str(root)).count() == 1


def logs_of_three(root):
    """Two plain files, one of several ranges, and a compressed one."""
    folder = folder_of(root)
    (folder / "0.log").write_text(line(1, "x") + line(2, "y"))
    (folder / "1.log").write_text("".join(line(3, f"{i:04d}") for i in range(200)))
    (folder / "2.log.gz").write_bytes(gzip.compress("".join(line(4, f"{i}") for i in range(9)).encode()))
    return folder


@pytest.mark.parametrize("name", ["0.log", "1.log", "2.log.gz"])
@pytest.mark.parametrize("how", ["gone", "cut"])
def test_a_file_that_cannot_be_read_any_more_fails_the_scan(spark, place, monkeypatch, name, how):
    """Its lines were left out, and the answer looked whole."""
    root, at = place
    monkeypatch.setattr(manifest, "RANGE_BYTES", 1000)
    folder = logs_of_three(root)
    found = manifest.update_manifest(spark, str(root), at)
    assert manifest.scan_files(found).count() == 2 + 200 + 9
    whole = (folder / name).read_bytes()
    (folder / name).unlink() if how == "gone" else (folder / name).write_bytes(whole[:-20])
    with pytest.raises(Exception, match="not as listed"):
        manifest.scan_files(found).collect()
    manifest.scan_files(found.where(~found.file_path.endswith(name))).collect()


def test_files_listed_as_broken_are_named_chosen_and_read_again(spark, place):
    root, at = place
    folder = logs_of_three(root)
    whole = (folder / "2.log.gz").read_bytes()
    stamp = (folder / "2.log.gz").stat()
    (folder / "2.log.gz").write_bytes(b"?" * len(whole))
    os.utime(folder / "2.log.gz", ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    found = manifest.update_manifest(spark, str(root), at)
    chosen = manifest.choose_files(found, since=dt.datetime(2024, 1, 3))
    assert sorted(r.file_path[-8:] for r in chosen.collect()) == ["2.log.gz", "pp/1.log"]
    with pytest.warns(UserWarning, match="2.log.gz"):
        assert manifest.scan_files(chosen).count() == 200
    with pytest.raises(RuntimeError, match="1 listed files could not be read to their end.*2.log.gz"):
        manifest.scan_files(chosen, keep_broken=False)
    (folder / "2.log.gz").write_bytes(whole)  # of the same length and time
    os.utime(folder / "2.log.gz", ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    found = manifest.update_manifest(spark, str(root), at)
    assert manifest.scan_files(found, keep_broken=False).count() == 2 + 200 + 9
