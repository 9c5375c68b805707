"""Container log lines → ``pod_logs`` rows.

Input lines carry ``namespace``, ``pod_name``, ``container_name`` and the text
``value``, with a ``line_no`` or the file and split they were read from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight import schemas
from harborlight.functions.levels import level_cascade, level_docs
from harborlight.functions.strict_json import evaluate_once, parse_objects, strict_str, whole
from harborlight.functions.text import is_blank, or_empty, trim_space
from harborlight.functions.times import parse_rfc3339, resolve_since, within
from harborlight.operators import filters, options
from harborlight.operators.enrich import with_source
from harborlight.operators.lookup import fits_broadcast, lookup_join, newest, reduced, version_order
from harborlight.operators.positional import (
    bytes_per_group,
    head_per_group,
    number_lines,
    place_of,
    tail_per_group,
)
from harborlight.operators.winners import stored

SOURCE_TYPE = "kubernetes_pod_logs"
CONTAINER = ["namespace", "pod_name", "container_name"]

# The timestamp prefix is 30 bytes, then one separator byte.
PREFIX_BYTES = 30

_POD_FIELDS = (
    "kind variant,"
    " metadata struct<name variant, namespace variant, resourceVersion variant, labels map<string,string>,"
    " annotations map<string,string>>,"
    " spec struct<nodeName variant, containers array<struct<name variant>>,"
    " initContainers array<struct<name variant>>>,"
    " status struct<containerStatuses array<struct<name variant, restartCount double,"
    " state struct<running variant, terminated variant>>>>"
)


def line_time(line: Column) -> Column:
    """The time in a line's timestamp prefix, NULL without one."""
    prefix = F.when(F.octet_length(line) > PREFIX_BYTES, F.substring(line, 1, PREFIX_BYTES))
    return parse_rfc3339(prefix)


def parse_timestamps(lines: DataFrame) -> DataFrame:
    """Split the timestamp prefix off ``value``: adds timestamp, ts_raw, log_message.

    Blank lines are dropped.  A line of exactly prefix and separator keeps its
    prefix in the message, and a line without a prefix is kept untrimmed.
    """
    line = F.col("value")
    size = F.octet_length(line)
    parsed = evaluate_once(lines.where(~is_blank(line)), timestamp=line_time(line))
    dated = F.col("timestamp").isNotNull()
    return parsed.withColumns(
        {
            "ts_raw": F.when(dated, F.substring(line, 1, PREFIX_BYTES)),
            "log_message": F.when(
                dated & (size > PREFIX_BYTES + 1),
                trim_space(F.substr(line, F.lit(PREFIX_BYTES + 2))),
            ).otherwise(line),
        }
    )


def add_levels(rows: DataFrame) -> DataFrame:
    """Add ``log_level`` from ``log_message``."""
    return (
        evaluate_once(rows, _level_docs=level_docs(F.col("log_message")))
        .withColumn("log_level", level_cascade(F.col("_level_docs"), F.col("log_message")))
        .drop("_level_docs")
    )


def pod_containers(objects: DataFrame, text: str = "value") -> DataFrame:
    """One row per container and init container of every pod in the object dumps.

    A pod that several dumps hold counts as its newest version: latest dump, then
    highest resource version.
    ``has_logs`` is a property of the pod: some container runs or has ended.
    Init containers report no restarts.
    """
    pods = parse_objects(objects, F.col(text), _POD_FIELDS, "pod").where(
        (strict_str(F.col("pod.kind")) == "Pod") & F.col("pod.metadata").isNotNull()
    )
    pods = newest(
        pods,
        [or_empty(strict_str(F.col(f"pod.metadata.{c}"))) for c in ("namespace", "name")],
        version_order(pods, strict_str(F.col("pod.metadata.resourceVersion")), F.col(text)),
    )
    statuses = F.col("pod.status.containerStatuses")
    no_containers = F.array().cast("array<struct<name:variant>>")
    exploded = pods.select(
        or_empty(strict_str(F.col("pod.metadata.namespace"))).alias("namespace"),
        or_empty(strict_str(F.col("pod.metadata.name"))).alias("pod_name"),
        or_empty(strict_str(F.col("pod.spec.nodeName"))).alias("node_name"),
        _map_or_empty("pod.metadata.labels").alias("labels"),
        _map_or_empty("pod.metadata.annotations").alias("annotations"),
        F.coalesce(
            F.exists(
                statuses,
                lambda s: s["state"]["running"].isNotNull() | s["state"]["terminated"].isNotNull(),
            ),
            F.lit(False),
        ).alias("has_logs"),
        F.transform(
            statuses,
            lambda s: F.named_struct(
                F.lit("name"), strict_str(s["name"]), F.lit("restarts"), whole(s["restartCount"])
            ),
        ).alias("_statuses"),
        F.posexplode(
            F.concat(
                F.coalesce(F.col("pod.spec.containers"), no_containers),
                F.coalesce(F.col("pod.spec.initContainers"), no_containers),
            )
        ).alias("container_index", "_container"),
    ).withColumn("container_name", or_empty(strict_str(F.col("_container.name"))))
    own = F.get(F.filter("_statuses", lambda s: s["name"] == F.col("container_name")), F.lit(0))
    return exploded.select(
        *CONTAINER,
        "container_index",
        "node_name",
        "labels",
        "annotations",
        F.coalesce(own["restarts"], F.lit(0)).alias("restart_count"),
        "has_logs",
    )


def _map_or_empty(path: str):
    return F.coalesce(F.col(path), F.create_map().cast("map<string,string>"))


def select_containers(
    containers: DataFrame,
    namespaces: Sequence[str] = (),
    pod_name_pattern: str | None = None,
    label_selectors: Sequence[str] | str = (),
) -> DataFrame:
    """Containers of pods that have logs and pass the pod filters."""
    chosen = filters.in_namespaces(containers.where("has_logs"), namespaces)
    chosen = filters.search(chosen, "pod_name", pod_name_pattern)
    chosen = filters.where_if(chosen, filters.has_labels(options.label_terms(label_selectors)))
    return chosen.drop("has_logs", "container_index")


def line_bytes():
    """Bytes a line takes in its log, with the line break."""
    return F.octet_length("value") + 1


def pod_logs(
    lines: DataFrame,
    containers: DataFrame,
    *,
    order: Sequence[str] | None = None,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    lookback: str | None = None,
    default_lookback: str | None = None,
    as_of: dt.datetime | None = None,
    namespaces: Sequence[str] | str = (),
    pod_name_pattern: str | None = None,
    label_selectors: Sequence[str] | str = (),
    log_levels: Sequence[str] = (),
    tail_lines: int | None = None,
    limit_bytes: int | None = None,
    limit_rows: int | None = None,
    limit: int | None = None,
    cluster_name: str = "",
    broadcast: bool | None = None,
) -> DataFrame:
    """``pod_logs`` rows of the selected containers.

    Tail, then byte budget, then parsing, level and time filters, then the
    per-container row limit, as the log endpoint and the reader apply them.
    ``order`` are the columns that order a container's lines, by default their
    place in the files or ``line_no``.  ``broadcast=None`` measures the container
    side first.
    """
    for name, value in (
        ("tail_lines", tail_lines),
        ("limit_bytes", limit_bytes),
        ("limit_rows", limit_rows),
        ("limit", limit),
    ):
        options.non_negative(name, value)
    namespaces = options.namespace_list(namespaces)
    pod_name_pattern = options.pattern("pod_name_pattern", pod_name_pattern)
    start = resolve_since(since, lookback, as_of, default_lookback)
    chosen = select_containers(containers, namespaces, pod_name_pattern, label_selectors)
    if not broadcast:
        # measured, reduced by and joined: parsed once for all of them
        chosen = stored(chosen, "containers")
    small = fits_broadcast(chosen) if broadcast is None else broadcast

    # namespace and pod name are path keys: these prune files before any read
    rows = filters.search(filters.in_namespaces(lines, namespaces), "pod_name", pod_name_pattern)
    rows = number_lines(rows)
    order = list(order or place_of(rows))
    if small:
        # free of a shuffle, so unwanted containers leave before the windows
        rows = lookup_join(rows, chosen, CONTAINER, broadcast=True)
    else:
        rows = reduced(rows, chosen, CONTAINER)
    if tail_lines is not None:
        rows = tail_per_group(rows, CONTAINER, order, tail_lines)
    if limit_bytes is not None:
        rows = bytes_per_group(
            rows, CONTAINER, order, line_bytes(), limit_bytes, group_rows=tail_lines
        )
    rows = filter_lines(parse_timestamps(rows), start, until, log_levels)
    if limit_rows is not None:
        rows = head_per_group(rows, CONTAINER, order, limit_rows)
    if not small:
        # after the windows: they must not inherit a per-container partitioning
        rows = lookup_join(rows, chosen, CONTAINER, broadcast=False)
    rows = filters.first_rows(rows, [*CONTAINER, *order], limit)
    rows = with_source(
        rows.withColumn("cluster_name", F.lit(cluster_name)), SOURCE_TYPE, cluster_name
    )
    return schemas.conform(rows, schemas.POD_LOGS)


def filter_lines(
    parsed: DataFrame,
    since: dt.datetime | None,
    until: dt.datetime | None,
    log_levels: Sequence[str] = (),
) -> DataFrame:
    """Time range (undated lines pass), then level (any letter case).

    Takes the output of :func:`parse_timestamps`; the time range is tested
    before levels are extracted.
    """
    bound = within(F.col("timestamp"), since, until)
    if bound is not None:
        parsed = parsed.where(F.col("timestamp").isNull() | bound)
    rows = add_levels(parsed)
    return filters.member(rows, "log_level", [level.upper() for level in log_levels])
