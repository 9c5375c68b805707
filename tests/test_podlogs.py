from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from harborlight.operators import podlogs
from helpers import by_line, lines, plan

NS9 = "2023-12-01T10:30:45.123456789Z"  # 30 bytes
OFFSET = "2023-12-01T10:30:45.1234+02:00"  # 30 bytes
SHORT = "2023-12-01T10:30:45.123456Z"  # 27 bytes


def test_prefix_byte_boundaries(spark):
    df = podlogs.parse_timestamps(
        lines(
            spark,
            NS9,  # 30 bytes: too short
            NS9 + " ",  # 31: dated, keeps its prefix as message
            NS9 + " x",  # 32
            NS9 + "   padded \t",
            OFFSET + " y",
            SHORT + "    too short a prefix",
            "2023-12-01 is a date, nothing more than that",
            "   \t ",
            "",
            "  no prefix, kept untrimmed  ",
            NS9 + "Xglued",  # any separator byte
            "é" * 16,  # 32 bytes, 16 characters
        )
    )
    assert by_line(df, "log_message") == {
        0: NS9,
        1: NS9 + " ",
        2: "x",
        3: "padded",
        4: "y",
        5: SHORT + "    too short a prefix",
        6: "2023-12-01 is a date, nothing more than that",
        9: "  no prefix, kept untrimmed  ",
        10: "glued",
        11: "é" * 16,
    }
    dated = {k: v for k, v in by_line(df, "ts_raw").items() if v}
    assert dated == {1: NS9, 2: NS9, 3: NS9, 4: OFFSET, 10: NS9}
    stamps = by_line(df.selectExpr("line_no", "cast(timestamp as string) ts"), "ts")
    assert stamps[2] == "2023-12-01 10:30:45.123456"
    assert stamps[4] == "2023-12-01 08:30:45.1234"


def pod(name, ns="default", statuses=(), init=(), labels=None, containers=("app",)):
    return json.dumps(
        {
            "kind": "Pod",
            "metadata": {"name": name, "namespace": ns, **({"labels": labels} if labels else {})},
            "spec": {
                "nodeName": "n1",
                "containers": [{"name": c} for c in containers],
                "initContainers": [{"name": c} for c in init],
            },
            "status": {"containerStatuses": list(statuses)},
        }
    )


def status(name, restarts, state="running"):
    return {"name": name, "restartCount": restarts, "state": {state: {"x": 1}}}


@pytest.fixture()
def pods(spark):
    return podlogs.pod_containers(
        lines(
            spark,
            pod("a", statuses=[status("app", 3), status("app", 9)], init=["setup"]),
            pod("b", statuses=[status("app", 1, "waiting")], labels={"app": "web"}),
            pod("c", statuses=[status("app", 0, "terminated")], labels={"app": "web", "t": "1"}),
            pod("d", ns="kube-system", statuses=[status("other", 5)], labels={"app": "web"}),
            pod("e"),
            '{"kind":"Service","metadata":{"name":"s"}}',
            "not json",
            '{"kind":"Pod"}',
        )
    )


def test_containers(pods):
    rows = pods.orderBy("pod_name", "container_index").collect()
    got = [(r.pod_name, r.container_name, r.restart_count, r.has_logs) for r in rows]
    assert got == [
        ("a", "app", 3, True),  # the first status of that name
        ("a", "setup", 0, True),  # init containers have no status here
        ("b", "app", 1, False),
        ("c", "app", 0, True),
        ("d", "app", 0, True),  # no status of its own, but the pod has logs
        ("e", "app", 0, False),
    ]
    assert rows[0].labels == {} and rows[0].annotations == {} and rows[0].node_name == "n1"


def test_selection(pods):
    def names(**kw):
        rows = podlogs.select_containers(pods, **kw).select("pod_name").distinct().collect()
        return sorted(r[0] for r in rows)

    assert names() == ["a", "c", "d"]
    assert names(namespaces=["kube-system"]) == ["d"]
    assert names(namespaces=["x", "*"]) == ["a", "c", "d"]
    assert names(pod_name_pattern="[ad]") == ["a", "d"]
    assert names(label_selectors=["app=web"]) == ["c", "d"]
    assert names(label_selectors="app=web,t=1") == ["c"]


@pytest.fixture()
def logs(spark):
    def stamp(i):
        return f"2024-01-01T00:00:{i:02d}.000000000Z "

    rows = [("default", "a", "app", stamp(i) + ("ERROR" if i % 2 else "ok"), i) for i in range(10)]
    rows += [("default", "a", "setup", "undated info", 0), ("default", "a", "setup", " ", 1)]
    rows += [("default", "b", "app", stamp(1) + "pod without logs", 0)]
    rows += [("default", "zzz", "app", stamp(1) + "unknown pod", 0)]
    rows += [("kube-system", "d", "app", stamp(3) + "warning", 0)]
    return spark.createDataFrame(
        rows,
        "namespace string, pod_name string, container_name string, value string, line_no long",
    )


def got(df):
    return sorted((r.pod_name, r.container_name, r.line_no) for r in df.collect())


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_pod_logs_pipeline(spark, logs, pods, broadcast):
    def run(**kw):
        return podlogs.pod_logs(logs, pods, broadcast=broadcast, **kw)

    everything = run(cluster_name="blue")
    assert got(everything) == [("a", "app", i) for i in range(10)] + [("a", "setup", 0), ("d", "app", 0)]
    row = everything.where("pod_name = 'a' and line_no = 1").first()
    assert (row.log_level, row.node_name, row.restart_count, row.cluster_name) == ("ERROR", "n1", 3, "blue")
    assert row.tp_source_name == "blue" and row.tp_source_type == "kubernetes_pod_logs"

    assert got(run(tail_lines=2, log_levels=["error"])) == [("a", "app", 9)]
    # the tail comes before the blank-line drop
    assert ("a", "setup", 0) not in got(run(tail_lines=1))
    assert got(run(log_levels=["Error"], limit_rows=2)) == [("a", "app", 1), ("a", "app", 3)]
    since, until = dt.datetime(2024, 1, 1, 0, 0, 3), dt.datetime(2024, 1, 1, 0, 0, 4)
    assert got(run(since=since, until=until)) == [
        ("a", "app", 3),
        ("a", "app", 4),
        ("a", "setup", 0),  # undated lines pass
        ("d", "app", 0),
    ]
    assert got(run(lookback="1s", as_of=dt.datetime(2024, 1, 1, 0, 0, 9)))[:2] == [
        ("a", "app", 8),
        ("a", "app", 9),
    ]
    assert got(run(limit=3)) == [("a", "app", 0), ("a", "app", 1), ("a", "app", 2)]
    # two lines of 33 bytes, then 36 more would not fit
    assert got(run(limit_bytes=34 + 37, pod_name_pattern="a")) == [
        ("a", "app", 0),
        ("a", "app", 1),
        ("a", "setup", 0),
    ]
    assert got(run(namespaces="kube-system")) == [("d", "app", 0)]


def test_lines_of_other_pods_leave_before_they_are_parsed(spark, logs, pods, monkeypatch):
    from harborlight.operators import lookup

    chosen = podlogs.select_containers(pods, pod_name_pattern="d")
    left = lookup.reduced(logs, chosen, podlogs.CONTAINER)
    assert {r.pod_name for r in left.collect()} == {"d"} and left.columns == logs.columns
    parsed = []
    real = podlogs.parse_timestamps

    def counted(rows):
        parsed.append(rows.count())
        return real(rows)

    monkeypatch.setattr(podlogs, "parse_timestamps", counted)
    labelled = pods.withColumn("labels", F.create_map(F.lit("pod"), F.col("pod_name")))
    rows = podlogs.pod_logs(logs, labelled, label_selectors="pod=d", broadcast=False).collect()
    assert parsed == [len(rows)] and {r.pod_name for r in rows} == {"d"}
    monkeypatch.setattr(lookup, "MAX_BROADCAST_KEYS", 0)  # too many to send: the join alone decides
    assert lookup.reduced(logs, chosen, podlogs.CONTAINER).count() == logs.count()


def test_negative_limits_are_rejected(logs, pods):
    for name in ("tail_lines", "limit_bytes", "limit_rows", "limit"):
        with pytest.raises(ValueError, match="cannot be negative"):
            podlogs.pod_logs(logs, pods, **{name: -1})


def test_lookup_strategy_is_measured(logs, pods):
    from harborlight.operators import lookup

    assert "BroadcastHashJoin" in plan(podlogs.pod_logs(logs, pods))
    assert lookup.fits_broadcast(pods)
    assert not lookup.fits_broadcast(pods, max_rows=3)
    assert not lookup.fits_broadcast(pods, max_bytes=10)


def test_salted_lookup_gives_the_same_rows(logs, pods):
    from harborlight.operators.lookup import lookup_join

    chosen = podlogs.select_containers(pods)
    plain = lookup_join(logs, chosen, podlogs.CONTAINER, True)
    salted = lookup_join(logs, chosen, podlogs.CONTAINER, False, salts=8)
    assert got(salted) == got(plain) and sorted(salted.columns) == sorted(plain.columns)


def test_a_pod_of_two_dumps_is_its_newest_version(spark):
    def pod(version, node, restarts):
        state = {"running": {}}
        return json.dumps(
            {
                "kind": "Pod",
                "metadata": {"name": "p", "namespace": "n", "resourceVersion": str(version)},
                "spec": {"nodeName": node, "containers": [{"name": "c"}]},
                "status": {"containerStatuses": [{"name": "c", "restartCount": restarts, "state": state}]},
            }
        )

    dumps = spark.createDataFrame([(pod(9, "old", 1),), (pod(10, "new", 2),), (pod(10, "new", 2),)], "value string")
    found = podlogs.pod_containers(dumps).collect()
    assert [(r.node_name, r.restart_count) for r in found] == [("new", 2)]
    line = spark.createDataFrame([("n", "p", "c", "x", 0)], "namespace string, pod_name string, container_name string, value string, line_no long")
    for broadcast in (True, False):
        rows = podlogs.pod_logs(line, podlogs.pod_containers(dumps), broadcast=broadcast).collect()
        assert [r.node_name for r in rows] == ["new"]
