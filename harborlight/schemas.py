"""Declared schemas of the four tables. Nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STR = T.StringType()
_TS = T.TimestampType()
_INT = T.IntegerType()
_TEXTS = T.ArrayType(_STR)
_TEXT_MAP = T.MapType(_STR, _STR)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def _of(dtype: T.DataType, *names: str) -> list[tuple[str, T.DataType]]:
    return [(n, dtype) for n in names]


_SOURCE = [*_of(_STR, "tp_source_name", "tp_source_type"), ("tp_collected_at", _TS)]

OWNER_REFERENCE = _struct(
    *_of(_STR, "api_version", "kind", "name", "uid"), ("controller", T.BooleanType())
)
CONDITION = _struct(
    *_of(_STR, "type", "status", "reason", "message"), ("last_transition_time", _TS)
)
REPLICAS = _struct(
    *_of(_INT, "desired", "current", "ready", "updated", "available", "unavailable")
)

POD_LOGS = _struct(
    ("timestamp", _TS),
    *_of(_STR, "namespace", "pod_name", "container_name", "log_message", "log_level"),
    ("node_name", _STR),
    *_of(_TEXT_MAP, "labels", "annotations"),
    ("restart_count", _INT),
    ("cluster_name", _STR),
    *_SOURCE,
    ("ts_raw", _STR),
    ("line_no", T.LongType()),
)

CLUSTER_EVENTS = _struct(
    ("timestamp", _TS),
    *_of(_STR, "namespace", "event_type", "reason", "message"),
    *_of(_STR, "object_kind", "object_name", "object_uid", "source_component", "source_host"),
    *_of(_TS, "first_timestamp", "last_timestamp"),
    ("count", T.LongType()),
    ("cluster_name", _STR),
    *_SOURCE,
    ("deduplication_key", _STR),
)

CLUSTER_RESOURCES = _struct(
    *_of(_STR, "namespace", "resource_type", "resource_name", "status"),
    ("created_at", _TS),
    *_of(_TEXT_MAP, "labels", "annotations"),
    ("spec", T.VariantType()),
    *_of(_STR, "node_name", "cluster_name", "uid"),
    ("owner_references", T.ArrayType(OWNER_REFERENCE)),
    ("resource_version", _STR),
    ("status_details", T.VariantType()),
    ("replicas", REPLICAS),
    ("conditions", T.ArrayType(CONDITION)),
    *_of(_STR, "service_type", "cluster_ip"),
    ("external_ips", _TEXTS),
    *_of(_STR, "ingress_class", "storage_class", "volume_mode"),
    ("access_modes", _TEXTS),
    *_of(_STR, "pod_ip", "phase"),
    ("restart_count", _INT),
    ("qos_class", _STR),
    *_SOURCE,
)

AUDIT_LOGS = _struct(
    *_of(_STR, "kind", "api_version", "level", "audit_id", "stage", "request_uri", "verb"),
    *_of(_STR, "user_name", "user_uid"),
    ("user_groups", _TEXTS),
    ("impersonated", T.BooleanType()),
    *_of(_STR, "namespace", "resource", "subresource", "name", "api_group", "resource_version"),
    *_of(_TS, "request_received_time", "stage_timestamp"),
    ("source_ips", _TEXTS),
    ("user_agent", _STR),
    ("response_code", _INT),
    *_of(_STR, "response_status", "response_reason"),
    *_of(_STR, "object_resource", "object_namespace", "object_name", "object_uid"),
    ("cluster_name", _STR),
    ("annotations", T.MapType(_STR, T.VariantType())),
    *_SOURCE,
    ("tp_id", _STR),
    *_of(_TS, "tp_timestamp", "tp_ingest_timestamp"),
    *_of(_STR, "tp_table", "tp_partition"),
    ("tp_date", T.DateType()),
)


def conform(
    df: DataFrame, schema: T.StructType, *extra: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Select the declared columns in order, or ``columns`` of them; absent ones become typed NULLs."""
    have = set(df.columns)
    if columns is not None:
        unknown = set(columns) - set(schema.names)
        if unknown:
            raise ValueError(f"no such columns: {sorted(unknown)}")
        schema = T.StructType([schema[c] for c in columns])

    def column(field: T.StructField) -> Column:
        if field.name in have:
            return F.col(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema], *[F.col(c) for c in extra])
