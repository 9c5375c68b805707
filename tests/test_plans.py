"""Properties the plans must keep at any scale."""

from __future__ import annotations

import re

import pytest

from harborlight import fixtures as fx
from harborlight import workload
from harborlight.operators import audit, events, podlogs, resources
from harborlight.sources import sink
from helpers import optimized, plan

SF_DIR = "/root/testdata/sf0.001"


def test_a_line_is_parsed_once_however_many_filters(spark):
    rows = audit.audit_logs(
        fx.audit_lines(spark, SF_DIR),
        verbs=["get"],
        resources=["pods"],
        namespaces=["default"],
        response_codes=[200],
        uri_pattern="x",
    )
    assert optimized(rows).count("Generate inline") == 1
    objects = resources.cluster_resources(
        fx.resource_pods(spark, SF_DIR), statuses=["Running"], name_pattern="p", ordered=False
    )
    assert optimized(objects).count("Generate inline") == 1
    seen = events.filter_events(
        events.parse_events(fx.event_objects(spark, SF_DIR)), event_types=["Warning"], message_pattern="e"
    )
    assert optimized(seen).count("Generate inline") == 1


def test_time_is_tested_before_levels_are_extracted(spark):
    parsed = podlogs.parse_timestamps(fx.log_lines(spark, SF_DIR))
    text = optimized(podlogs.filter_lines(parsed, workload.SINCE, None, ["ERROR"]))
    level = text.index("Generate inline")
    time_filter = next(m.start() for m in re.finditer(r"Filter .*timestamp", text) if m.start() > level)
    assert time_filter > level  # deeper in the tree: runs earlier


def test_scans_read_only_what_is_used(spark):
    rows = resources.cluster_resources(fx.resource_pods(spark, SF_DIR), ordered=False)
    text = plan(rows.groupBy("namespace").count())
    scan = next(line for line in text.splitlines() if "customer.parquet" in line)
    assert "c_acctbal" not in scan and "c_name" not in scan


def test_questions_reach_the_collected_files(spark):
    text = plan(workload.all_queries()["q4_failed_authentication"](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)
    assert "In(response_code, [401,403])" in pushed.group(1)
    assert "GreaterThan(stage_timestamp" in pushed.group(1)
    assert "user_agent" not in pushed.group(2)
    assert re.search(r"PartitionFilters: \[[^\]]*tp_date#\d+ >= 2024-01-15", text)
    text = plan(workload.all_queries()["q1_recent_errors"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*tp_date#\d+ >= 2024-01-15", text)
    text = plan(workload.all_queries()["q3_pods_per_namespace"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*resource_type#\d+ = Pod", text)


@pytest.mark.parametrize("name", sorted(workload.all_queries()))
def test_no_cross_joins_and_no_python(spark, name):
    if name.startswith(("stream_", "sink_", "scan_", "audit_file", "audit_tail", "audit_source")):
        pytest.skip("runs a job while planning; covered by its batch twin")
    text = plan(workload.all_queries()[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ArrowEval"):
        assert banned not in text


def test_large_lookups_are_shuffled(spark):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        rows = podlogs.pod_logs(
            fx.log_lines(spark, SF_DIR),
            podlogs.pod_containers(fx.pod_objects(spark, SF_DIR)),
            broadcast=False,
            tail_lines=3,
        )
        text = plan(rows)
    finally:
        spark.conf.set(conf, before)
    join = text.index("SortMergeJoin")
    assert "WindowGroupLimit" in text[join:]  # windows run before the join
    # and lines of other pods leave before the windows
    assert text.index("LeftSemi", join) > text.index("WindowGroupLimit", join)


def test_sink_rebalances_by_partition(spark, tmp_path):
    rows = workload.keyed_audit(fx.audit_lines(spark, SF_DIR))
    assert "REBALANCE" in plan(rows.hint("rebalance", *sink.PARTITIONS)).upper()
