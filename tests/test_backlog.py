from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from harborlight.operators import events
from harborlight.sources import landed
from harborlight.streaming import backlog, runs, watch


def event(name, count, text, kind="Normal"):
    return json.dumps(
        {
            "metadata": {"namespace": "default"},
            "type": kind,
            "reason": "Pulled",
            "message": text,
            "involvedObject": {"kind": "Pod", "name": name},
            "lastTimestamp": f"2024-01-01T00:00:{count:02d}Z",
            "count": count,
        }
    )


def shown(df):
    rows = df.select("object_name", "message", F.col("count").alias("n"), F.second("last_timestamp").alias("s"))
    return sorted(tuple(r) for r in rows.collect())


class Place:
    def __init__(self, spark, tmp_path):
        self.spark, self.source = spark, tmp_path / "in"
        self.backlog, self.state, self.checkpoint = (str(tmp_path / n) for n in ("backlog", "state", "check"))
        self.source.mkdir()
        self.files = 0

    def land(self, *texts, **filters):
        file = self.source / f"{self.files}.json"
        file.write_text("".join(t + "\n" for t in texts))
        os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1
        return self.stream(**filters)

    def stream(self, **filters):
        lines = landed.stream_placed_lines(self.spark, str(self.source), 1)
        assert runs.finish(backlog.land_events(lines, self.backlog, self.checkpoint, **filters))

    def take(self, n=None, **how):
        return backlog.merge_next(self.spark, self.backlog, self.state, n, buckets=4, **how)

    def rows(self):
        return shown(watch.watched_events(self.spark, self.state))


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_exactly_so_many_and_the_rest_later(place):
    assert place.take(5) == 0 and backlog.landed(place.spark, place.backlog) == 0
    place.land(event("a", 1, "first"), event("b", 2, "x"), event("a", 3, "y"), event("c", 4, "z"))
    assert place.take(0) == 0 and place.rows() == []
    assert place.take(3) == 3
    assert place.rows() == [("a", "first", 4, 3), ("b", "x", 2, 2)]
    place.land(event("c", 5, "later"), event("b", 6, "last"))
    assert place.take(2) == 2  # one of each file
    assert place.rows() == [("a", "first", 4, 3), ("b", "x", 2, 2), ("c", "z", 9, 5)]
    assert place.take() == 1 and place.take() == 0
    final = place.rows()
    assert final == [("a", "first", 4, 3), ("b", "x", 8, 6), ("c", "z", 9, 5)]
    assert shown(events.cluster_events(landed.scan_lines(place.spark, str(place.source)))) == final
    with pytest.raises(ValueError):
        place.take(-1)


def test_filtered_events_are_not_counted(place):
    texts = [event(f"n{i}", 1, "m", "Warning" if i % 3 == 0 else "Normal") for i in range(9)]
    place.land(*texts, event_types=["Warning"])
    assert backlog.landed(place.spark, place.backlog) == 3
    assert place.take(2) == 2 and [r[0] for r in place.rows()] == ["n0", "n3"]


def test_numbers_are_consecutive_over_ranges(place):
    place.land(*[event(f"n{i}", 1, str(i)) for i in range(3000)])
    place.land()
    place.land(*[event(f"n{i}", 1, str(i)) for i in range(3000, 3500)])
    rows = place.spark.read.parquet(f"{place.backlog}/rows").select("message", backlog.NUMBER).collect()
    assert sorted((int(m), n) for m, n in rows) == [(i, i) for i in range(3500)]


def test_a_failed_trigger_lands_its_events_once(place, monkeypatch):
    place.land(event("a", 1, "x"))
    real = type(place.spark).createDataFrame

    def dies(self, rows, schema):
        if schema == backlog._ENDS:
            raise RuntimeError("lost after the rows")
        return real(self, rows, schema)

    monkeypatch.setattr(type(place.spark), "createDataFrame", dies)
    with pytest.raises(Exception, match="lost"):
        place.land(event("a", 2, "y"), event("b", 3, "z"))
    monkeypatch.undo()
    assert backlog.landed(place.spark, place.backlog) == 1
    assert place.take() == 1  # what an unfinished trigger left is not taken
    place.stream()
    assert place.take() == 2 and place.rows() == [("a", "x", 3, 2), ("b", "z", 3, 3)]


def test_a_failed_run_takes_the_same_events_again(place, monkeypatch):
    place.land(*[event(f"n{i % 7}", 1, str(i)) for i in range(50)])
    assert place.take(10) == 10
    before = place.rows()
    real = watch.write_manifest

    def dies(*args):
        raise RuntimeError("lost after the rows")

    monkeypatch.setattr(watch, "write_manifest", dies)
    with pytest.raises(RuntimeError):
        place.take(20)
    assert place.rows() == before
    monkeypatch.setattr(watch, "write_manifest", real)
    assert place.take(20) == 20 and sum(r[2] for r in place.rows()) == 30
    assert place.take() == 20 and sum(r[2] for r in place.rows()) == 50


def test_old_keys_are_forgotten(place):
    place.land(event("a", 1, "x"), event("b", 30, "y"), event("c", 40, "z"))
    assert place.take(2, forget_after=dt.timedelta(seconds=20)) == 2
    assert [r[0] for r in place.rows()] == ["b"]
