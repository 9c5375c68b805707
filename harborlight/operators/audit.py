"""API-server audit lines → ``audit_logs`` rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight import schemas
from harborlight.functions.identity import audit_identity, identity_time
from harborlight.functions.members import Members, chosen, parse, with_sources
from harborlight.functions.text import empty_to_null, or_empty
from harborlight.functions.times import instant, parse_rfc3339, resolve_since, within
from harborlight.operators import filters, options
from harborlight.operators.enrich import with_source
from harborlight.operators.positional import (
    head_per_group,
    number_lines,
    place_of,
    tail_per_group,
)

SOURCE_TYPE = "kubernetes_audit_logs"

_LINE_FIELDS = (
    "kind string, apiVersion string, level string, auditID string, stage string,"
    " requestURI string, verb string, userAgent string,"
    " user struct<username string, uid string, groups array<string>>,"
    " objectRef struct<namespace string, resource string, subresource string,"
    " name string, apiGroup string, apiVersion string>,"
    " requestReceivedTimestamp string, stageTimestamp string, sourceIPs array<string>,"
    " responseStatus struct<code double, status string, reason string>,"
    " annotations map<string,variant>"
)

# Columns that are empty text when missing; the other texts are NULL then.
_PLAIN_TEXT = {
    "api_version": "apiVersion",
    "level": "level",
    "audit_id": "auditID",
    "stage": "stage",
    "request_uri": "requestURI",
    "verb": "verb",
}
_OPTIONAL_TEXT = {
    "user_name": "user.username",
    "user_uid": "user.uid",
    "namespace": "objectRef.namespace",
    "resource": "objectRef.resource",
    "subresource": "objectRef.subresource",
    "name": "objectRef.name",
    "api_group": "objectRef.apiGroup",
    "resource_version": "objectRef.apiVersion",
    "user_agent": "userAgent",
    "response_status": "responseStatus.status",
    "response_reason": "responseStatus.reason",
}


def parse_audit(
    lines: DataFrame,
    cluster_name: str = "",
    text: str = "value",
    keep: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Audit entries of the lines; everything else is dropped silently.

    ``keep`` names input columns (a file path, a line position) to carry along.  Only
    members that ``columns`` (all by default) need are parsed.
    """
    m = Members(_LINE_FIELDS, text)
    builders = {
        "kind": lambda: m.raw("kind"),
        **{c: lambda p=p: or_empty(m.text(p)) for c, p in _PLAIN_TEXT.items()},
        **{c: lambda p=p: empty_to_null(m.text(p)) for c, p in _OPTIONAL_TEXT.items()},
        "user_groups": lambda: m.texts("user.groups"),
        "impersonated": lambda: F.lit(False),
        "request_received_time": lambda: parse_rfc3339(m.raw("requestReceivedTimestamp")),
        "stage_timestamp": lambda: parse_rfc3339(m.raw("stageTimestamp")),
        "source_ips": lambda: m.texts("sourceIPs"),
        "response_code": lambda: m.count("responseStatus.code"),
        "cluster_name": lambda: F.lit(cluster_name),
        "annotations": lambda: m.raw("annotations"),
    }
    built = chosen(builders, columns)
    # "Event" and a time cannot be the text of anything but a string
    is_entry = m.raw("kind") == "Event"
    # only text that begins like an object reaches the parser
    entries = parse(lines.where(F.col(text).rlike(r"^\s*\{")), m).where(is_entry)
    return entries.select(*keep, *[c.alias(n) for n, c in built.items()])


def event_time() -> Column:
    return F.coalesce("stage_timestamp", "request_received_time")


TIMES = ("stage_timestamp", "request_received_time")
#: the columns each filter reads, and those that source columns are computed from
FILTER_COLUMNS = {
    "since": TIMES,
    "until": TIMES,
    "user_names": ["user_name"],
    "user_groups": ["user_groups"],
    "namespaces": ["namespace"],
    "resources": ["resource"],
    "verbs": ["verb"],
    "levels": ["level"],
    "stages": ["stage"],
    "source_ips": ["source_ips"],
    "user_agents": ["user_agent"],
    "response_codes": ["response_code"],
    "uri_pattern": ["request_uri"],
}
IDENTITY = ("audit_id", "verb", "resource", "namespace", "name", "request_uri")
SOURCE_COLUMNS = {
    "tp_timestamp": TIMES,
    "tp_date": TIMES,
    "tp_id": (*IDENTITY, *TIMES),
}


def filter_audit(
    rows: DataFrame,
    *,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    user_names: Sequence[str] = (),
    user_groups: Sequence[str] = (),
    namespaces: Sequence[str] | str = (),
    resources: Sequence[str] = (),
    verbs: Sequence[str] = (),
    levels: Sequence[str] = (),
    stages: Sequence[str] = (),
    source_ips: Sequence[str] = (),
    user_agents: Sequence[str] = (),
    response_codes: Sequence[int] = (),
    uri_pattern: str | None = None,
) -> DataFrame:
    """Keep entries that pass every given filter; undated entries pass the range."""
    bound = within(event_time(), since, until)
    if bound is not None:
        rows = rows.where(event_time().isNull() | bound)
    rows = filters.member(rows, "user_name", user_names)
    rows = filters.in_namespaces(rows, options.namespace_list(namespaces))
    rows = filters.member(rows, "resource", resources)
    rows = filters.member(rows, "verb", verbs)
    rows = filters.member(rows, "level", levels)
    rows = filters.member(rows, "stage", stages)
    rows = filters.member(rows, "user_agent", user_agents)
    rows = filters.member(rows, "response_code", response_codes)
    rows = filters.overlaps(rows, "user_groups", user_groups)
    rows = filters.overlaps(rows, "source_ips", source_ips)
    return filters.search(rows, "request_uri", options.pattern("uri_pattern", uri_pattern))


def enrich_audit(
    rows: DataFrame,
    partition: str,
    table: str = SOURCE_TYPE,
    cluster_name: str = "",
    range_start: dt.datetime | None = None,
    collected_at: dt.datetime | None = None,
) -> DataFrame:
    """Add source columns, ids, event time, UTC day and partition name.

    Source columns whose inputs were not parsed are left out.
    """
    sourced = with_source(rows, SOURCE_TYPE, cluster_name, collected_at)
    start = instant(range_start) if range_start is not None else None
    added = {
        "tp_timestamp": event_time,
        "tp_ingest_timestamp": lambda: F.col("tp_collected_at"),
        "tp_table": lambda: F.lit(table),
        "tp_partition": lambda: F.lit(partition),
        "tp_date": lambda: F.to_date(event_time()),
        "tp_id": lambda: audit_identity(
            *[F.col(c) for c in IDENTITY], identity_time(event_time(), range_start=start)
        ),
    }
    have = set(rows.columns)
    able = [n for n in added if have.issuperset(SOURCE_COLUMNS.get(n, ()))]
    return sourced.withColumns({n: added[n]() for n in able})


def audit_logs(
    lines: DataFrame,
    *,
    partition: str = "default",
    cluster_name: str = "",
    stream_keys: Sequence[str] = ("file_path",),
    order: Sequence[str] | None = None,
    since: dt.datetime | None = None,
    lookback: str | None = None,
    default_lookback: str | None = None,
    as_of: dt.datetime | None = None,
    limit_per_stream: int | None = None,
    tail_lines: int | None = None,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
    **audit_filters,
) -> DataFrame:
    """``audit_logs`` rows of landed lines.

    With ``columns`` only those are returned, and only what they and the filters need is parsed.

    ``stream_keys`` identify one input file or stream, ``order`` the position of
    a line in it (by default its place in the file); both are only read when a
    positional limit is set.
    """
    for name, value in (
        ("limit_per_stream", limit_per_stream),
        ("tail_lines", tail_lines),
        ("limit", limit),
    ):
        options.non_negative(name, value)
    start = resolve_since(since, lookback, as_of, default_lookback)
    positional = any(v is not None for v in (limit_per_stream, tail_lines, limit))
    keep: list[str] = []
    if positional:
        lines = number_lines(lines)
        order = list(order or [c for c in place_of(lines) if c not in stream_keys])
        keep = [*stream_keys, *order]
    if tail_lines is not None:
        lines = tail_per_group(lines, list(stream_keys), order, tail_lines)
    needed = None
    if columns is not None:
        used = [f for f, v in {"since": start, **audit_filters}.items() if v]
        needed = with_sources([*columns, *(c for f in used for c in FILTER_COLUMNS[f])], SOURCE_COLUMNS)
    parsed = parse_audit(lines, cluster_name, keep=keep, columns=needed)
    rows = filter_audit(parsed, since=start, **audit_filters)
    if limit_per_stream is not None:
        rows = head_per_group(rows, list(stream_keys), order, limit_per_stream)
    rows = filters.first_rows(rows, keep, limit)
    enriched = enrich_audit(rows, partition, cluster_name=cluster_name, range_start=start)
    return schemas.conform(enriched, schemas.AUDIT_LOGS, columns=columns)
