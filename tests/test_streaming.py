from __future__ import annotations

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from harborlight.operators import audit, events, podlogs
from harborlight.operators.collect_once import with_collect_key
from harborlight.sources import by_tasks, landed
from harborlight.streaming import runs, tables, watch
from helpers import lines


def event(name, count, second, version):
    return json.dumps(
        {
            "metadata": {"namespace": "default", "resourceVersion": str(version)},
            "type": "Normal",
            "reason": "Pulled",
            "message": f"m{version}",
            "involvedObject": {"kind": "Pod", "name": name},
            "lastTimestamp": None if second is None else f"2024-01-01T00:00:{second:02d}Z",
            "count": count,
        }
    )


def shown(df):
    rows = df.select(
        "object_name", "message", F.col("count").alias("n"), F.date_format("last_timestamp", "ss").alias("s")
    )
    return sorted(tuple(r) for r in rows.collect())


def test_watch_updates_and_resumes(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()

    def run():
        df = tables.watch_events(landed.stream_lines(spark, str(source), 1))
        assert runs.finish(runs.update_to_table(df, out, check))

    (source / "1.json").write_text(event("a", 1, 9, 1) + "\n" + event("b", 1, None, 2) + "\n")
    run()
    assert shown(runs.latest_rows(spark, out, "deduplication_key")) == [
        ("a", "m1", 1, "09"),
        ("b", "m2", 1, None),
    ]
    (source / "2.json").write_text(event("a", 5, 3, 3) + "\n" + event("a", 1, None, 4) + "\n")
    run()  # same checkpoint: continues with the kept state
    latest = runs.latest_rows(spark, out, "deduplication_key")
    assert shown(latest) == [("a", "m1", 7, "03"), ("b", "m2", 1, None)]
    batch = events.cluster_events(landed.scan_lines(spark, str(source)))
    assert shown(batch) == shown(latest)


def test_follow(spark, tmp_path):
    folder = tmp_path / "in" / "namespace=default" / "pod_name=p" / "container_name=app"
    folder.mkdir(parents=True)
    stamp = "2024-01-01T00:00:00.000000000Z "
    (folder / "0.log").write_text(f"{stamp}level=error x\n{stamp}fine\n \nundated error\n")
    pod = {
        "kind": "Pod",
        "metadata": {"name": "p", "namespace": "default"},
        "spec": {"containers": [{"name": "app"}]},
        "status": {"containerStatuses": [{"name": "app", "restartCount": 2, "state": {"running": {"a": 1}}}]},
    }
    containers = podlogs.pod_containers(lines(spark, json.dumps(pod)))
    for name, small in (("b", True), ("s", False)):
        df = tables.follow_logs(
            landed.stream_container_logs(spark, str(tmp_path / "in")),
            containers,
            log_levels=["ERROR"],
            broadcast=small,
        )
        out = str(tmp_path / f"out-{name}")
        runs.finish(runs.append_to_table(df, out, str(tmp_path / f"check-{name}")))
        rows = spark.read.parquet(out).collect()
        assert sorted(r.log_message for r in rows) == ["level=error x", "undated error"]
        assert {r.restart_count for r in rows} == {2}


def audit_entry(i, second):
    return json.dumps(
        {"kind": "Event", "auditID": f"a{i}", "verb": "get", "stageTimestamp": f"2024-01-01T00:00:{second:02d}Z"}
    )


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_collect_once_across_triggers(spark, tmp_path, delay):
    source = tmp_path / "in"
    source.mkdir()
    first = [audit_entry(1, 1), audit_entry(1, 2), audit_entry(2, 1), audit_entry(2, 1)]
    (source / "1.log").write_text("\n".join(first) + "\n")
    (source / "2.log").write_text("\n".join([audit_entry(1, 2), audit_entry(3, 5)]) + "\n")
    rows = audit.parse_audit(landed.stream_lines(spark, str(source), 1))
    keyed = with_collect_key(rows, F.col("audit_id"), F.col("stage_timestamp"))
    once = tables.collect_once_stream(keyed, "stage_timestamp", delay)
    out = str(tmp_path / "out")
    slim = once.select("audit_id", F.date_format("stage_timestamp", "ss").alias("s"))
    runs.finish(runs.append_to_table(slim, out, str(tmp_path / "check")))
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [("a1", "01"), ("a1", "02"), ("a2", "01"), ("a3", "05")]


def test_bounded_run_stops(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text(event("a", 1, 9, 1) + "\n")
    df = tables.watch_events(landed.stream_lines(spark, str(source)))
    query = runs.update_to_table(df, str(tmp_path / "o"), str(tmp_path / "c"), until_idle=False)
    assert runs.finish(query, timeout_seconds=8) is False
    assert not query.isActive
    assert runs.latest_rows(spark, str(tmp_path / "o"), "deduplication_key").count() == 1


def test_watch_merges_in_arrival_order(spark, tmp_path):
    """Versions run against arrival; the stream agrees with the batch merge of the same files."""
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()

    def run(**kw):
        stream = landed.stream_placed_lines(spark, str(source), 1)
        return runs.finish(watch.watch_to_table(stream, out, check, **kw))

    (source / "1.json").write_text(event("a", 1, 5, 9) + "\n" + event("a", 1, 2, 8) + "\n")
    assert run()
    assert shown(watch.watched_events(spark, out)) == [("a", "m9", 2, "02")]
    (source / "2.json").write_text(event("a", 4, None, 7) + "\n" + event("b", 1, 1, 1) + "\n")
    (source / "3.json").write_text(event("b", 2, 30, 0) + "\n")
    landed_at = (source / "2.json").stat().st_mtime
    os.utime(source / "3.json", (landed_at + 5, landed_at + 5))
    assert run()  # same checkpoint: goes on with the stored state
    final = shown(watch.watched_events(spark, out))
    assert final == [("a", "m9", 6, "02"), ("b", "m1", 3, "30")]
    assert shown(events.cluster_events(landed.scan_lines(spark, str(source)))) == final


def test_watch_reads_changes_and_stops_after_rows(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(4):
        change = {"type": "MODIFIED", "object": json.loads(event("a", 1, i, i))}
        (source / f"{i}.json").write_text(json.dumps(change) + "\n")
        os.utime(source / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = landed.stream_placed_lines(spark, str(source), 1)
    out = str(tmp_path / "out")
    query = watch.watch_to_table(stream, out, str(tmp_path / "c"), watch=True, until_idle=False)
    assert runs.finish(query, timeout_seconds=60, most_rows=2) is False
    assert not query.isActive
    (row,) = watch.watched_events(spark, out).collect()
    assert 2 <= row["count"] <= 4 and row.message == "m0"


def stored_files(folder):
    """Row files of a watch state and when each was written."""
    found = (os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))
    return {path: os.stat(path).st_mtime_ns for path in found}


def test_trigger_writes_only_its_buckets(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()

    def run():
        stream = landed.stream_placed_lines(spark, str(source), 1)
        assert runs.finish(watch.watch_to_table(stream, out, check, buckets=16))

    (source / "1.json").write_text("".join(event(f"n{i}", 1, 1, i) + "\n" for i in range(200)))
    run()
    before = stored_files(f"{out}/rows")
    assert len(before) == 16
    for turn in range(2):  # the second writes over what the first file wrote
        (source / f"2{turn}.json").write_text(event("n7", 1, 2, 900) + "\n")
        run()
        after = stored_files(f"{out}/rows")
        changed = [f for f, t in after.items() if before.get(f) != t]
        assert len(changed) == 1 and len(after) == 17
        before = after
    rows = {r[0]: r[2] for r in shown(watch.watched_events(spark, out))}
    assert len(rows) == 200 and rows["n7"] == 3 and rows["n8"] == 1


def test_watch_survives_a_failed_trigger(spark, tmp_path, monkeypatch):
    """A trigger that dies after its rows were written is repeated without harm."""
    stage = "write_manifest"
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()

    def run():
        stream = landed.stream_placed_lines(spark, str(source), 1)
        return runs.finish(watch.watch_to_table(stream, out, check, buckets=4))

    (source / "1.json").write_text(event("a", 1, 5, 1) + "\n" + event("b", 1, 5, 1) + "\n")
    run()
    (source / "2.json").write_text(event("a", 2, 7, 2) + "\n" + event("c", 1, 1, 1) + "\n")
    real, died = getattr(watch, stage), []

    def dies(*args):
        died.append(1)
        raise RuntimeError("lost after the rows")

    monkeypatch.setattr(watch, stage, dies)
    with pytest.raises(Exception, match="lost"):
        run()
    assert died and shown(watch.watched_events(spark, out)) == [("a", "m1", 1, "05"), ("b", "m1", 1, "05")]
    monkeypatch.setattr(watch, stage, real)
    run()
    assert shown(watch.watched_events(spark, out)) == [("a", "m1", 3, "07"), ("b", "m1", 1, "05"), ("c", "m1", 1, "01")]


def test_watch_forgets_old_keys(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    import datetime as dt

    def run(name, *texts):
        (source / name).write_text("".join(t + "\n" for t in texts))
        stream = landed.stream_placed_lines(spark, str(source), 1)
        assert runs.finish(watch.watch_to_table(stream, out, check, forget_after=dt.timedelta(seconds=10), buckets=2))

    run("1.json", event("a", 1, 5, 1), event("b", 1, 20, 1))
    assert [r[0] for r in shown(watch.watched_events(spark, out))] == ["b"]
    run("2.json", event("a", 4, 21, 2), event("c", 1, 40, 1))
    assert [r[:3] for r in shown(watch.watched_events(spark, out))] == [("c", "m1", 1)]
    run("3.json", event("b", 7, 39, 2))  # forgotten before, so it starts anew
    assert [r[:3] for r in shown(watch.watched_events(spark, out))] == [("b", "m2", 7), ("c", "m1", 1)]


def land_log(root, name, *texts, pod="p"):
    folder = root / "namespace=default" / f"pod_name={pod}" / "container_name=app"
    folder.mkdir(parents=True, exist_ok=True)
    data = "".join(t + "\n" for t in texts).encode()
    (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)


def test_followed_logs_are_listed_by_tasks_and_read_once(spark, tmp_path):
    """Spark's file source held the names of all landed files on the driver, at each trigger."""
    root, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run(files_per_trigger=None):
        lines = landed.stream_container_logs(spark, str(root), files_per_trigger, listing=str(tmp_path / "listing"))
        query = runs.append_to_table(lines, out, check)
        assert runs.finish(query)
        assert all("listing" in s.description for s in query.lastProgress.sources)
        triggers = [p.batchId for p in query.recentProgress if p.numInputRows]
        found = spark.read.parquet(out)
        assert found.columns == ["value", "namespace", "pod_name", "container_name"]
        return sorted((r.pod_name, r.value) for r in found.collect()), len(triggers)

    for i in range(20):
        land_log(root, "0.log", f"first {i}", pod=f"p{i}")
    want = sorted((f"p{i}", f"first {i}") for i in range(20))
    assert run() == (want, 1)
    assert run()[0] == want  # nothing new
    land_log(root, "1.log.gz", "second", "third", pod="p3")
    want = sorted([*want, ("p3", "second"), ("p3", "third")])
    assert run()[0] == want
    for i in range(7):
        land_log(root, "2.log", f"more {i}", pod="p4")
        land_log(root, f"{3 + i}.log", f"last {i}", pod="p4")
    want = sorted([*want, ("p4", "more 6"), *(("p4", f"last {i}") for i in range(7))])
    got, triggers = run(2)
    assert got == want and triggers >= 4
    assert len(list((tmp_path / "listing").glob("*.parquet"))) < 20


def test_a_running_stream_sees_logs_that_land(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(by_tasks, "PAUSE_SECONDS", 0.5)
    monkeypatch.setattr(by_tasks, "SHARE", 0)
    root, out = tmp_path / "in", str(tmp_path / "out")
    land_log(root, "0.log", "first")
    lines = landed.stream_container_logs(spark, str(root), listing=str(tmp_path / "listing"))
    query = runs.append_to_table(lines, out, str(tmp_path / "check"), until_idle=False)
    deadline = time.monotonic() + 90

    def values():
        return sorted(r.value for r in spark.read.parquet(out).collect())

    while query.lastProgress is None and time.monotonic() < deadline:
        time.sleep(0.2)
    land_log(root, "1.log", "second")
    while values() != ["first", "second"] and time.monotonic() < deadline:
        time.sleep(0.5)
    assert values() == ["first", "second"]

    def fails(*_):
        raise PermissionError("not yours")

    monkeypatch.setattr(by_tasks, "update_listing", fails)
    with pytest.raises(RuntimeError, match="could not be listed"), pytest.warns(UserWarning, match="not yours"):
        runs.finish(query, timeout_seconds=60)
    assert not query.isActive and query.lastProgress is not None


def test_a_bounded_follow_counts_lines_not_files(spark, tmp_path):
    land_log(tmp_path / "in", "0.log", *map(str, range(9)))
    lines = landed.stream_container_logs(spark, str(tmp_path / "in"), listing=str(tmp_path / "listing"))
    query = runs.append_to_table(lines, str(tmp_path / "out"), str(tmp_path / "check"), until_idle=False)
    assert runs.finish(query, timeout_seconds=60, most_rows=9) is False
    assert [by_tasks.rows_read(p) for p in query.recentProgress if p.numInputRows] == [9]


def test_a_listing_that_died_half_way_is_completed(spark, tmp_path):
    root, listing = tmp_path / "in", tmp_path / "listing"
    for i in range(10):
        land_log(root, f"{i}.log", f"{i}")
    full = by_tasks.address(spark, str(root))
    assert by_tasks.update_listing(spark, full, str(listing), 3)[1] == 10
    parts = sorted(listing.glob("*.parquet"))
    lost = sum(spark.read.parquet(str(p)).count() for p in parts[1:])
    for part in parts[1:]:
        part.unlink()
    assert by_tasks.update_listing(spark, full, str(listing), 3)[1] == lost
    assert by_tasks.update_listing(spark, full, str(listing), 3)[1] == 0
    files = [r.file_path for r in spark.read.parquet(str(listing)).collect()]
    assert len(files) == len(set(files)) == 10
