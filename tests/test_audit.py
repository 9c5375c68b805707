from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harborlight import schemas
from harborlight.operators import audit, winners
from harborlight.operators.collect_once import (
    collect_once,
    not_yet_collected,
    surplus,
    with_collect_key,
)
from harborlight.operators.winners import numbered
from helpers import by_line, lines, optimized, plan

FULL = {
    "kind": "Event",
    "apiVersion": "audit.k8s.io/v1",
    "level": "Request",
    "auditID": "id-1",
    "stage": "ResponseComplete",
    "requestURI": "/api/v1/secrets",
    "verb": "get",
    "user": {"username": "jo", "uid": "7", "groups": ["a", 5, None, "b", {"x": 1}]},
    "objectRef": {
        "namespace": "default",
        "resource": "secrets",
        "subresource": "status",
        "name": "s",
        "apiGroup": "g",
        "apiVersion": "v1",
    },
    "requestReceivedTimestamp": "2024-01-01T00:00:00.100000Z",
    "stageTimestamp": "2024-01-01T00:00:01Z",
    "sourceIPs": ["10.0.0.1", 9],
    "userAgent": "curl",
    "responseStatus": {"code": 403.9, "status": "Failure", "reason": "Forbidden"},
    "annotations": {"k": "v", "n": {"deep": [1]}},
}


def entry(**changes) -> str:
    return json.dumps({**FULL, **changes})


def parse(spark, *texts):
    return audit.parse_audit(lines(spark, *texts), cluster_name="c", keep=["line_no"])


def test_full_entry(spark):
    row = parse(spark, entry()).first().asDict()
    assert row["user_groups"] == ["a", "b"] and row["source_ips"] == ["10.0.0.1"]
    assert (row["user_name"], row["user_uid"], row["user_agent"]) == ("jo", "7", "curl")
    assert row["resource_version"] == "v1" and row["api_group"] == "g"
    assert row["response_code"] == 403 and row["response_reason"] == "Forbidden"
    assert row["impersonated"] is False and row["cluster_name"] == "c"
    assert str(row["annotations"]["n"].toPython()) == "{'deep': [1]}"


def test_only_audit_entries_survive(spark):
    texts = [
        entry(),
        "",
        "not json",
        "5",
        "null",
        '["x"]',
        entry(kind="Pod"),
        entry(kind=5),
        json.dumps({"verb": "get"}),
        entry() + " trailing",
        entry() + entry(),
        entry() + "," + entry(),
        entry()[:-1],
        "  " + entry() + "\t",
        "2024-01-01T00:00:00Z " + entry(),
        '{"kind":"Pod","kind":"Event"}',  # the last duplicate counts
        '{"kind":"Event","kind":"Pod"}',
    ]
    assert sorted(by_line(parse(spark, *texts), "kind")) == [0, 13, 15]


@pytest.mark.parametrize("wrong", [5, 1.5, True, None, {"x": "y"}, ["z"]])
def test_wrong_types_are_missing(spark, wrong):
    plain = {k: wrong for k in ("apiVersion", "level", "auditID", "stage", "requestURI", "verb")}
    row = parse(spark, entry(**plain, userAgent=wrong)).first()
    assert [row[c] for c in ("api_version", "level", "audit_id", "stage", "request_uri", "verb")] == [
        ""
    ] * 6
    assert row.user_agent is None
    nested = {"username": wrong, "groups": wrong if wrong != ["z"] else 3}
    row = parse(spark, entry(user=nested, stageTimestamp=wrong)).first()
    assert (row.user_name, row.user_groups, row.stage_timestamp) == (None, None, None)
    row = parse(spark, entry(user="text", objectRef=wrong, responseStatus=[1])).first()
    assert (row.user_name, row.namespace, row.resource, row.response_code) == (None,) * 4


def test_response_codes(spark):
    texts = [entry(responseStatus={"code": c}) for c in (200, 403.0, 403.9, -1.5, "403", 1e12, True)]
    got = by_line(parse(spark, *texts), "response_code")
    assert got == {0: 200, 1: 403, 2: 403, 3: -1, 4: None, 5: None, 6: None}


def test_bad_times_are_null(spark):
    row = parse(spark, entry(stageTimestamp="yesterday")).first()
    assert row.stage_timestamp is None and row.request_received_time is not None


def kept(rows, **options):
    return sorted(by_line(audit.filter_audit(rows, **options), "verb"))


def test_filters(spark):
    rows = parse(
        spark,
        entry(),
        entry(stageTimestamp="x", verb="list"),
        entry(stageTimestamp="x", requestReceivedTimestamp="x", user={}),
        entry(objectRef={"resource": "pods"}, requestURI="/a/bind", userAgent="kubectl"),
        entry(stage="Panic", level="Metadata", sourceIPs=[], responseStatus={}),
    ).cache()
    assert kept(rows) == [0, 1, 2, 3, 4]
    start = dt.datetime(2024, 1, 1, 0, 0, 1)
    assert kept(rows, since=start) == [0, 2, 3, 4]  # undated entries pass
    assert kept(rows, until=start) == [0, 1, 2, 3, 4]  # inclusive
    assert kept(rows, user_names=["jo"]) == [0, 1, 3, 4]
    assert kept(rows, user_names=[""]) == [2]  # a missing name compares as empty
    assert kept(rows, namespaces=["default"]) == [0, 1, 2, 4]
    assert kept(rows, namespaces="x,*") == [0, 1, 2, 3, 4]
    assert kept(rows, resources=["pods"]) == [3]
    assert kept(rows, verbs=["list"]) == [1] and kept(rows, verbs=["LIST"]) == []
    assert kept(rows, levels=["Metadata"]) == [4] and kept(rows, stages=["Panic"]) == [4]
    assert kept(rows, uri_pattern="bind$") == [3]
    assert kept(rows, user_groups=["b", "zz"]) == [0, 1, 3, 4]
    assert kept(rows, source_ips=["10.0.0.1"]) == [0, 1, 2, 3]
    assert kept(rows, user_agents=["kubectl"]) == [3]
    assert kept(rows, response_codes=[403]) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        kept(rows, uri_pattern="(")


def test_audit_logs_table(spark):
    placed = lines(spark, *[entry(auditID=f"i{i}", verb="get" if i % 2 else "list") for i in range(8)])
    placed = placed.withColumns(
        {"file_path": F.expr("if(line_no < 4, 'f1', 'f2')"), "block_start": F.lit(0).cast("long")}
    )

    def ids(**kw):
        return sorted(r.audit_id for r in audit.audit_logs(placed, **kw).collect())

    table = audit.audit_logs(placed, partition="p", cluster_name="blue")
    assert [f.name for f in table.schema] == [
        f.name for f in schemas.AUDIT_LOGS
    ]
    assert [f.dataType.simpleString() for f in table.schema] == [
        f.dataType.simpleString() for f in schemas.AUDIT_LOGS
    ]
    row = table.first()
    assert (row.tp_partition, row.tp_table, row.tp_source_name) == ("p", "kubernetes_audit_logs", "blue")
    assert row.tp_date == dt.date(2024, 1, 1) and row.tp_ingest_timestamp == row.tp_collected_at
    assert ids(verbs=["get"], limit_per_stream=1) == ["i1", "i5"]
    assert ids(tail_lines=1) == ["i3", "i7"]
    assert ids(tail_lines=2, verbs=["list"]) == ["i2", "i6"]
    assert ids(limit=3) == ["i0", "i1", "i2"]
    with pytest.raises(ValueError):
        audit.audit_logs(placed, limit=-1)


def test_collect_once(spark):
    rows = spark.createDataFrame(
        [
            ("a", "2024-01-01 00:00:00.0011", 1),
            ("a", "2024-01-01 00:00:00.0019", 2),  # same millisecond
            ("a", "2024-01-01 00:00:00.002", 3),
            ("b", "2024-01-01 00:00:00.001", 5),
            ("b", "2024-01-01 00:00:00.001", 4),
            ("c", None, 6),
            ("c", None, 7),
        ],
        "id string, t string, n int",
    )
    keyed = with_collect_key(rows, F.col("id"), F.col("t").cast("timestamp"))
    once = collect_once(keyed, [F.col("n")])
    assert sorted(r.n for r in once.collect()) == [1, 3, 4, 6]
    seen = once.where("n in (3, 6)")
    assert sorted(r.n for r in not_yet_collected(once, seen).collect()) == [1, 4]


def test_collect_once_moves_keys_only(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("n"), F.repeat(F.lit("wide"), 50).alias("payload"), (F.col("id") % 7).cast("string").alias("i")
    )
    keyed = with_collect_key(rows.unionByName(rows), F.concat("i", "n"), F.timestamp_millis(F.col("n") % 3))
    once = collect_once(keyed, ["n"])
    assert "SortAggregate" not in plan(once) and "Sort [" not in plan(once)
    assert once.count() == 1000 and once.columns == keyed.columns
    travelling = plan(surplus(numbered(keyed, "test", ["n"])))
    assert "SortAggregate" not in travelling and "payload" not in travelling
    shuffled = winners.BROADCAST_NUMBERS
    winners.BROADCAST_NUMBERS = 0
    try:
        many = collect_once(keyed, ["n"])
        assert "ShuffledHashJoin" in plan(many) and sorted(many.collect()) == sorted(once.collect())
    finally:
        winners.BROADCAST_NUMBERS = shuffled


def test_only_asked_members_are_parsed(spark):
    """Filters and source columns bring in what they need, nothing else is built."""
    frame = lines(spark, entry(), entry(verb="list", auditID=""), entry(kind="Other"))
    few = audit.audit_logs(frame, columns=["tp_id", "user_groups"], verbs=["get", "list"], response_codes=[403])
    text = optimized(few)
    assert few.columns == ["tp_id", "user_groups"]
    for member in ("kind", "verb", "groups", "code", "auditID", "stageTimestamp"):
        assert f"StructField({member}," in text, member
    for member in ("annotations", "userAgent", "sourceIPs", "username", "apiGroup", "status", "level"):
        assert f"StructField({member}," not in text, member
    whole = audit.audit_logs(frame, verbs=["get", "list"], response_codes=[403])
    assert sorted(few.collect()) == sorted(whole.select("tp_id", "user_groups").collect())
    with pytest.raises(ValueError):
        audit.audit_logs(frame, columns=["nothing"])
