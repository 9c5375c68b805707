"""Row identities used for merging and for collecting every row once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborlight.functions.text import empty_to_null, or_empty
from harborlight.functions.times import ZERO_TIME_TEXT, rfc3339_text


def joined(separator: str, *parts: Column) -> Column:
    """Join with NULL as empty text (``concat_ws`` alone would skip it)."""
    return F.concat_ws(separator, *[or_empty(p) for p in parts])


def event_merge_key(
    namespace: Column, reason: Column, kind: Column, name: Column, component: Column
) -> Column:
    return F.md5(joined(":", namespace, reason, kind, name, component))


def identity_time(*candidates: Column, range_start: Column | None = None) -> Column:
    """First known time of a row, else the start of the collected range."""
    known = list(candidates) + ([range_start] if range_start is not None else [])
    return F.coalesce(*known)


def _time_text(ts: Column) -> Column:
    return F.coalesce(rfc3339_text(ts), F.lit(ZERO_TIME_TEXT))


def audit_identity(
    audit_id: Column,
    verb: Column,
    resource: Column,
    namespace: Column,
    name: Column,
    request_uri: Column,
    ts: Column,
) -> Column:
    fallback = joined("|", verb, resource, namespace, name, request_uri, _time_text(ts))
    return F.coalesce(empty_to_null(audit_id), fallback)


def pod_log_identity(
    namespace: Column, pod_name: Column, container_name: Column, ts: Column, ts_raw: Column
) -> Column:
    """Nanosecond digits of the raw prefix are kept; trailing zeros are cut."""
    fraction = F.regexp_extract(ts_raw, r"[.,](\d*?)0*(?:Z|[+-])", 1)
    seconds = F.replace(
        F.date_trunc("SECOND", ts).cast("string"), F.lit(" "), F.lit("T")
    )
    exact = F.concat(
        seconds, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("Z")
    )
    text = F.coalesce(F.when(ts_raw.isNotNull(), exact), _time_text(ts))
    return joined("|", namespace, pod_name, container_name, text)


def event_identity(
    merge_key: Column,
    namespace: Column,
    event_type: Column,
    reason: Column,
    kind: Column,
    name: Column,
    ts: Column,
) -> Column:
    fallback = joined("|", namespace, event_type, reason, kind, name, _time_text(ts))
    return F.coalesce(empty_to_null(merge_key), fallback)
