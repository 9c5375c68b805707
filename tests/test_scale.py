"""Plans and task counts that decide whether larger tables fit."""

from __future__ import annotations

from harborlight import workload
from harborlight.operators.lookup import lookup_join
from helpers import plan

SF = "/root/testdata/sf0.001"


def test_api_server_lines_pass_no_entries_through_the_driver(spark):
    """The entries were joined with their pods by Spark's estimate: whole audit entries were broadcast."""
    mixed = workload.mixed_container_lines(spark, SF)
    assert "Broadcast" not in plan(mixed)


def test_a_lookup_that_was_not_measured_small_is_shuffled(spark):
    logs = spark.createDataFrame([("0", 1), ("1", 2)], "pod_name string, line_no long")
    pods = spark.range(1).selectExpr("string(id) AS pod_name", "concat('n', id) AS node_name")  # tiny by estimate
    for salts in (1, 4):
        joined = lookup_join(logs, pods, ["pod_name"], False, salts=salts)
        assert "Broadcast" not in plan(joined)
        assert [(r.line_no, r.node_name) for r in joined.collect()] == [(1, "n0")]


def test_a_followed_log_is_shuffled_once_and_not_copied(spark, tmp_path):
    """A lookup too large to broadcast was copied 32 times, parsed anew by every trigger, and then broadcast."""
    from harborlight.streaming import tables

    lines = spark.readStream.schema("value string, namespace string, pod_name string, container_name string").text(
        str(tmp_path)
    )
    followed = tables.follow_logs(lines, workload.containers(spark, SF), broadcast=False)
    shown = followed._jdf.queryExecution().analyzed().toString()
    assert "explode" not in shown and "from_json" not in shown.split("Relation")[-1]
    assert "strategy=merge" in shown


def test_lines_without_keys_or_text_are_landed_as_by_spark(spark, tmp_path):
    from harborlight import fixtures as fx
    from harborlight.sources import landed

    rows = [("default", "p", "app", None, 1), (None, "p", "app", "x", 2)]
    lines = spark.createDataFrame(
        rows, "namespace string, pod_name string, container_name string, value string, line_no long"
    )
    fx.write_logs(lines, str(tmp_path / "logs"))
    found = landed.scan_container_logs(spark, str(tmp_path / "logs")).select("namespace", "value").collect()
    assert {tuple(r) for r in found} == {("default", ""), (None, "x")}


def test_base_rows_are_spread_over_tasks_by_rows(spark, monkeypatch):
    """One file of a base table was one task, whatever texts its rows are turned into."""
    from harborlight import fixtures as fx

    monkeypatch.setattr(fx, "TASK_ROWS", 40)
    pods = fx.resource_pods(spark, SF)
    assert pods.rdd.getNumPartitions() == fx.table(spark, SF, "customer").count() // 40 + 1
    assert pods.count() == fx.table(spark, SF, "customer").count()


def test_paths_are_opened_by_tasks_that_stay_apart(spark, tmp_path, monkeypatch):
    """Folders and files were spread by key alone, and AQE put their tiny rows into one task."""
    from harborlight.sources import growing

    for i in range(40):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "0.log").write_text(f"line {i}\n")
    seen = []
    kept = growing.stored
    monkeypatch.setattr(growing, "stored", lambda df, why: seen.append(plan(df)) or kept(df, why))
    files = growing.list_files(spark, str(tmp_path))
    assert files.count() == 40
    assert any("REPARTITION_BY_NUM" in p and "path" in p for p in seen)
    assert not any("REPARTITION_BY_COL" in p for p in seen)
    assert growing.path_tasks(spark, 0) == 1
    assert growing.path_tasks(spark, 10**6) == 10**6 // growing.TASK_PATHS + 1


def test_lines_of_small_files_share_a_batch():
    import pyarrow as pa

    from harborlight.sources.growing import together

    small = [pa.RecordBatch.from_pydict({"line": [f"{i}"]}) for i in range(50)]
    joined = list(together(iter(small)))
    assert len(joined) == 1
    assert joined[0].column("line").to_pylist() == [str(i) for i in range(50)]
    assert list(together(iter([]))) == []


def test_containers_are_parsed_once_for_a_log_query(spark, monkeypatch):
    """They were parsed to be measured, to reduce the lines, and again for the join."""
    from harborlight import fixtures as fx
    from harborlight.operators import podlogs

    chosen = workload.containers(spark, SF)
    rows = podlogs.pod_logs(fx.log_lines(spark, SF), chosen, broadcast=False)
    assert "customer" not in plan(rows).lower() and "c_custkey" not in plan(rows)


def stores_of(monkeypatch, *modules):
    """(purpose, columns) of whatever these modules store from now on."""
    from harborlight.operators import winners

    kept, seen = winners.stored, []
    for module in modules:
        monkeypatch.setattr(module, "stored", lambda df, why: seen.append((why, df.columns)) or kept(df, why))
    return seen


def test_landed_events_are_aggregated_once_by_their_place(spark, tmp_path, monkeypatch):
    """Unused members and a file order per line were stored, keys stored again, and joined twice with their bests."""
    from harborlight.operators import events, winners
    from harborlight.sources import landed

    for part, texts in ((10, ["late"]), (9, ["first", "second"])):  # 9.json comes before 10.json
        rows = [f'{{"reason":"R","message":"{t}","lastTimestamp":"2024-01-01T00:00:{part}Z","count":2}}' for t in texts]
        (tmp_path / f"{part}.json").write_text("\n".join(r.replace(":9Z", ":09Z") for r in rows) + "\n")
    seen = stores_of(monkeypatch, events, winners)
    merged = events.cluster_events(landed.scan_objects(spark, str(tmp_path))).collect()
    assert [(r.message, r["count"], r.last_timestamp.second) for r in merged] == [("first", 6, 10)]
    assert [why for why, _ in seen] == ["events", "ranks", "event-facts"]
    assert not {"labels", "resource_version", "file_order"} & set(seen[0][1])


def test_backlog_numbers_events_without_moving_them(spark, tmp_path, monkeypatch):
    """All rows of a trigger were sorted by range and stored a second time."""
    from harborlight.operators import winners
    from harborlight.sources import landed
    from harborlight.streaming import backlog, runs

    (tmp_path / "in").mkdir()
    for part in (10, 9):
        rows = [f'{{"reason":"R","message":"{part}.{i}","type":"{"Normal" if i % 3 else "Warning"}"}}' for i in range(9)]
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(rows) + "\n")
    seen = stores_of(monkeypatch, backlog, winners)
    lines = landed.stream_placed_lines(spark, str(tmp_path / "in"))
    runs.finish(backlog.land_events(lines, f"{tmp_path}/log", f"{tmp_path}/check", event_types=["Normal"]))
    landed_rows = spark.read.parquet(f"{tmp_path}/log/rows").orderBy(backlog.NUMBER).select("message", backlog.NUMBER)
    want = [f"{part}.{i}" for part in (9, 10) for i in range(9) if i % 3]
    assert [tuple(r) for r in landed_rows.collect()] == [(m, n) for n, m in enumerate(want)]
    assert [why for why, _ in seen] == ["backlog-rows", "backlog-splits"]
    backlog.merge_next(spark, f"{tmp_path}/log", f"{tmp_path}/state", 5)
    assert "events" not in [why for why, _ in seen]


def test_events_are_landed_by_tasks_of_a_quarter_million(spark, monkeypatch):
    """One task wrote a million events, and texts instead of base rows were sorted."""
    from harborlight import fixtures as fx

    ranged = fx.table(spark, SF, "events").repartitionByRange(2, "event_id").sortWithinPartitions("event_id")
    shown = plan(fx.event_objects_of(ranged))
    assert shown.index("kubelet") < shown.index("Sort")
    monkeypatch.setattr(fx, "table", lambda *_: spark.range(3_000_000))
    assert workload.files_per_part(spark, SF) == 4


def test_partitions_are_joined_up_to_sizes_that_a_sort_can_hold(spark):
    """Compressed telemetry was joined to 64 MB a task, which were hundreds of megabytes in a sort."""
    from pyspark.sql import functions as F

    first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    spark.conf.set(first, "false")
    try:
        rows = spark.range(3_000_000).select(*[F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(2)])
        parts = rows.repartition("c0").select(F.spark_partition_id().alias("p"), "c1").where("c1 IS NOT NULL")
        assert parts.select("p").distinct().count() > 1
    finally:
        spark.conf.unset(first)
