from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harborlight.operators import events
from harborlight.operators.winners import POSITION, ROW, numbered, tied
from helpers import by_line, lines, plan

NOW = dt.datetime(2024, 6, 1, tzinfo=dt.timezone.utc)


def stamp(second: int) -> str:
    return f"2024-01-01T00:00:{second:02d}Z"


def event(name="p", count=1, first=None, last=None, at=None, **changes) -> str:
    body = {
        "metadata": {"namespace": "default", "labels": {"team": "x"}},
        "type": "Normal",
        "reason": "Pulled",
        "message": "pulled image",
        "involvedObject": {"kind": "Pod", "name": name, "uid": "u", "namespace": "default"},
        "source": {"component": "kubelet", "host": "h"},
        "firstTimestamp": None if first is None else stamp(first),
        "lastTimestamp": None if last is None else stamp(last),
        "eventTime": None if at is None else stamp(at),
        "count": count,
    }
    return json.dumps({**body, **changes})


def parse(spark, *texts, **kw):
    return events.parse_events(lines(spark, *texts), as_of=NOW, keep=["line_no"], **kw)


def seconds(df, *columns):
    texts = df.select(
        "line_no", *[F.date_format(c, "MM-dd ss").alias(c) for c in columns]
    )
    return by_line(texts, *columns)


def test_time_fallbacks(spark):
    rows = parse(
        spark,
        event(first=1, last=2, at=3),
        event(first=1, at=3),
        event(at=3),
        event(first=1),
        event(),
        event(lastTimestamp="0001-01-01T00:00:00Z", firstTimestamp=5, at=4),
    )
    assert seconds(rows, "timestamp", "first_timestamp", "last_timestamp") == {
        0: ("01-01 02", "01-01 01", "01-01 02"),
        1: ("01-01 03", "01-01 01", "01-01 03"),
        2: ("01-01 03", None, "01-01 03"),
        3: ("01-01 01", "01-01 01", None),
        4: ("06-01 00", None, None),
        5: ("01-01 04", None, "01-01 04"),
    }


def test_row_fields(spark):
    row = parse(spark, event(count=4, involvedObject={"kind": 3}, source={})).first()
    assert (row.namespace, row.event_type, row.reason, row["count"]) == ("default", "Normal", "Pulled", 4)
    assert (row.object_kind, row.object_name, row.object_uid) == ("", "", None)
    assert (row.source_component, row.source_host) == ("", None)


def test_watch_envelopes(spark):
    texts = [
        json.dumps({"type": "ADDED", "object": json.loads(event(last=1))}),
        json.dumps({"type": "ERROR", "object": "gone"}),
    ]
    rows = parse(spark, *texts, watch=True)
    assert [(r.change_type, r.reason) for r in rows.collect()] == [("ADDED", "Pulled")]


def kept(rows, **options):
    return sorted(by_line(events.filter_events(rows, **options), "reason"))


def test_filters(spark):
    rows = parse(
        spark,
        event(first=1, last=9),
        event(first=1, at=9),  # the range looks at first before event time
        event(at=9, type="Warning", reason="BackOff"),
        event(name="q", message="Error: 7", source={"component": "scheduler"}),
        event(first=5, metadata={"namespace": "kube-system"}),
    ).cache()
    start, end = dt.datetime(2024, 1, 1, 0, 0, 5), dt.datetime(2024, 1, 1, 0, 0, 9)
    assert kept(rows) == [0, 1, 2, 3, 4]
    assert kept(rows, since=start) == [0, 2, 4]  # undated 3 fails once a bound is set
    assert kept(rows, until=end) == [0, 1, 2, 4]
    assert kept(rows, namespaces=["kube-system"]) == [4]
    assert kept(rows, event_types=["Warning"]) == [2]
    assert kept(rows, object_kinds=["Pod"]) == [0, 1, 2, 3, 4]
    assert kept(rows, object_names=["q"]) == [3]
    assert kept(rows, source_components=["scheduler"]) == [3]
    assert kept(rows, message_pattern=r"\d") == [3]
    assert kept(rows, reason_pattern="^Back") == [2]
    assert kept(rows, label_selectors=["team=x"]) == [0, 1, 2, 3]
    for bad in ({"message_pattern": "("}, {"label_selectors": "a in b"}, {"namespaces": "A_b"}):
        with pytest.raises(ValueError):
            kept(rows, **bad)
    assert sorted(by_line(events.events_of_namespace(rows, "default"), "reason")) == [0, 1, 2, 3]


def test_merge_follows_arrival(spark):
    rows = parse(
        spark,
        event(count=2, first=3, last=9, message="first"),
        event(count=3, first=1, last=5, message="second"),  # later arrival, earlier time
        event(count=4, message="undated"),  # changes only the count
        event(name="alone", count=1),
        event(name="late", count=1),
        event(name="late", count=1, at=7),
    )
    streamed = events.merge_events(rows, F.col("line_no"))
    merged = events.merge_landed(rows, ["line_no"])
    assert sorted(merged.collect()) == sorted(streamed.collect())
    got = {
        r.object_name: (r.message, r["count"], r.f, r.l, r.t)
        for r in merged.select(
            "object_name",
            "message",
            "count",
            F.date_format("first_timestamp", "ss").alias("f"),
            F.date_format("last_timestamp", "ss").alias("l"),
            F.date_format("timestamp", "MM ss").alias("t"),
        ).collect()
    }
    assert got == {
        "p": ("first", 9, "03", "05", "01 05"),
        "alone": ("pulled image", 1, None, None, "06 00"),
        "late": ("pulled image", 2, None, "07", "01 07"),
    }


def test_merge_is_hashed_and_combines_before_the_shuffle(spark):
    spread = events.parse_events(lines(spark, event()).repartition(4), keep=["line_no"])
    merged = plan(events.merge_landed(spread, ["line_no"]))
    assert "SortAggregate" not in merged and "Sort [" not in merged
    narrow = numbered(spread, "test", ["line_no"]).select("deduplication_key", POSITION, ROW)
    picked = plan(tied(narrow, ["deduplication_key"]).groupBy("deduplication_key").agg(F.min(ROW)))
    assert "SortAggregate" not in picked
    assert "partial_min(_position" in picked[picked.index("Exchange") :]
    assert "message" not in picked  # only keys, order and numbers travel


def test_merge_by_place_in_files(spark):
    """Texts in the order count as ranks; ties go to equal content, once."""
    rows = parse(spark, *[event(name=f"n{i % 3}", count=1, message=f"m{i}") for i in range(12)])
    placed = rows.withColumns({"file": F.concat(F.lit("f"), F.lit(9) - F.col("line_no") % 4), "at": F.col("line_no") % 2})
    placed = placed.unionByName(placed)
    got = {r.object_name: (r.message, r["count"]) for r in events.merge_landed(placed, ["file", "at"]).collect()}
    want = {}
    for i in sorted(range(12), key=lambda i: (9 - i % 4, i % 2)):
        want.setdefault(f"n{i % 3}", f"m{i}")
    assert {n: m for n, (m, _) in got.items()}.keys() == want.keys()
    for name, (message, count) in got.items():
        i, j = int(message[1:]), int(want[name][1:])
        assert (9 - i % 4, i % 2) == (9 - j % 4, j % 2) and count == 8


def test_table_limit_and_default_order(spark):
    texts = [
        event(count=1, last=9, metadata={"namespace": "n", "resourceVersion": "10"}, message="b"),
        event(count=1, last=3, metadata={"namespace": "n", "resourceVersion": "9"}, message="a"),
    ]
    def merged(df):
        row = events.cluster_events(df, as_of=NOW, cluster_name="c").first()
        return (row.message, row["count"], row.last_timestamp.second, row.cluster_name)

    assert merged(lines(spark, *texts)) == ("b", 2, 3, "c")  # arrival in lines
    assert merged(lines(spark, *texts).drop("line_no")) == ("a", 2, 9, "c")  # by version
    many = lines(spark, *[event(name=f"n{i}") for i in range(9)])
    assert events.cluster_events(many, as_of=NOW, limit=4).count() == 4


def test_only_asked_members_are_parsed(spark):
    """A computed column brings in what it is computed from."""
    frame = lines(spark, event(first=1, last=3), event(at=2, reason="Other"))
    full = events.parse_events(frame, as_of=NOW)
    for asked, absent in (
        (["timestamp"], ("message", "labels", "involvedObject", "resourceVersion")),
        (["deduplication_key", "count"], ("message", "labels", "firstTimestamp")),
        (["cluster_name"], ("message", "metadata", "lastTimestamp")),
    ):
        few = events.parse_events(frame, as_of=NOW, columns=asked)
        plan = few._jdf.queryExecution().optimizedPlan().toString()
        assert not any(f"StructField({member}," in plan for member in absent), asked
        assert few.select(*asked).collect() == full.select(*asked).collect()


def test_event_filter_takes_all_types_and_kinds(spark):
    """The query passes both event types and all three kinds of objects to the filter."""
    from harborlight import workload

    sf_dir = "/root/testdata/sf0.01"
    kinds = "regexp_extract(value, '\"involvedObject\":.\"kind\":\"([A-Za-z]+)', 1)"
    found = workload.all_queries()["event_filter"](spark, sf_dir).select("line_no", "reason")
    met = found.join(workload.fx.event_objects(spark, sf_dir).selectExpr("line_no", f"{kinds} AS kind"), "line_no")
    assert {r.reason for r in met.select("reason").collect()} == {"BackOff", "Pulled"}
    assert {r.kind for r in met.select("kind").collect()} == {"Pod", "Node", "Deployment"}
