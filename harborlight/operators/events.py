"""Cluster event objects → ``cluster_events`` rows, merged by key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight import schemas
from harborlight.functions.identity import event_merge_key
from harborlight.functions.members import Members, chosen, parse, with_sources
from harborlight.functions.strict_json import strict_str, text_at
from harborlight.functions.text import empty_to_null, is_blank, or_empty
from harborlight.functions.times import instant, parse_object_time, resolve_since, within
from harborlight.operators import filters, options
from harborlight.operators.enrich import with_source
from harborlight.operators.positional import number_lines, place_of
from harborlight.operators.winners import (
    AT,
    POSITION,
    RANK,
    ROW,
    by_number,
    least_row,
    numbered,
    ranked,
    side_by_side,
    stored,
    tied,
)

SOURCE_TYPE = "kubernetes_events"

# Resource versions are strings of digits, which only a VARIANT leaf keeps apart
# from numbers at no extra parse.
_EVENT_FIELDS = (
    "metadata struct<namespace string, resourceVersion variant, labels map<string,string>>,"
    " type string, reason string, message string,"
    " involvedObject struct<kind string, name string, uid string, namespace string>,"
    " source struct<component string, host string>,"
    " firstTimestamp string, lastTimestamp string, eventTime string, count double"
)

_PLAIN_TEXT = {
    "namespace": "metadata.namespace",
    "event_type": "type",
    "reason": "reason",
    "message": "message",
    "object_kind": "involvedObject.kind",
    "object_name": "involvedObject.name",
    "source_component": "source.component",
}
_OPTIONAL_TEXT = {
    "object_uid": "involvedObject.uid",
    "source_host": "source.host",
    "involved_namespace": "involvedObject.namespace",
}


def parse_events(
    lines: DataFrame,
    *,
    as_of: dt.datetime | None = None,
    cluster_name: str = "",
    text: str = "value",
    keep: Sequence[str] = (),
    watch: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per event object, unmerged.

    ``timestamp`` falls back to the collection time ``as_of``.  Besides the table
    columns the rows carry the three times before the fallback rules, labels,
    the involved object's namespace and the resource version.  ``watch`` reads
    change envelopes and adds ``change_type``.  Only members that ``columns`` (all by
    default) need are parsed.
    """
    m = Members(_EVENT_FIELDS, text, below="object" if watch else "")
    now = instant(as_of) if as_of is not None else F.current_timestamp()

    def time(path: str) -> Column:
        return parse_object_time(m.raw(path))

    builders = {
        **{c: lambda p=p: or_empty(m.text(p)) for c, p in _PLAIN_TEXT.items()},
        **{c: lambda p=p: empty_to_null(m.text(p)) for c, p in _OPTIONAL_TEXT.items()},
        "resource_version": lambda: empty_to_null(strict_str(m.raw("metadata.resourceVersion"))),
        "labels": lambda: m.raw("metadata.labels"),
        "first_timestamp": lambda: time("firstTimestamp"),
        "own_last_timestamp": lambda: time("lastTimestamp"),
        "event_time": lambda: time("eventTime"),
        "count": lambda: F.coalesce(m.count("count"), F.lit(0)).cast("long"),
        "cluster_name": lambda: F.lit(cluster_name),
    }
    later = {
        "last_timestamp": lambda: F.coalesce("own_last_timestamp", "event_time"),
        "timestamp": lambda: F.coalesce("last_timestamp", "first_timestamp", now),
        "deduplication_key": lambda: event_merge_key(*[F.col(c) for c in KEY_COLUMNS]),
    }
    needed = None if columns is None else with_sources(columns, DERIVED_FROM)
    built = chosen(builders, needed)
    if not m.asked:
        m.raw("reason")  # whatever is asked, a row is an object
    doc = parse(lines.where(~is_blank(F.col(text))), m, more="type string" if watch else "")
    if watch:
        doc = doc.where(F.col("doc.object").isNotNull())
    rows = doc.select(
        *keep,
        *([text_at("doc", "type", text).alias("change_type")] if watch else []),
        *[c.alias(n) for n, c in built.items()],
    )
    for name, value in later.items():
        if needed is None or name in needed:
            rows = rows.withColumn(name, value())
    return rows


KEY_COLUMNS = ("namespace", "reason", "object_kind", "object_name", "source_component")
RANGE_TIMES = ("own_last_timestamp", "first_timestamp", "event_time")
#: what computed columns are computed from, and the columns each filter reads
DERIVED_FROM = {
    "last_timestamp": ("own_last_timestamp", "event_time"),
    "timestamp": ("last_timestamp", "first_timestamp"),
    "deduplication_key": KEY_COLUMNS,
}
FILTER_COLUMNS = {
    "since": RANGE_TIMES,
    "until": RANGE_TIMES,
    "namespaces": ["namespace"],
    "event_types": ["event_type"],
    "object_kinds": ["object_kind"],
    "object_names": ["object_name"],
    "source_components": ["source_component"],
    "label_selectors": ["labels"],
    "message_pattern": ["message"],
    "reason_pattern": ["reason"],
}


def filter_events(
    rows: DataFrame,
    *,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    namespaces: Sequence[str] | str = (),
    event_types: Sequence[str] = (),
    object_kinds: Sequence[str] = (),
    object_names: Sequence[str] = (),
    source_components: Sequence[str] = (),
    label_selectors: Sequence[str] | str = (),
    message_pattern: str | None = None,
    reason_pattern: str | None = None,
) -> DataFrame:
    """Keep events that pass every given filter.

    The range looks at last, first, then event time (not the order ``timestamp``
    uses), and an event with none of them fails as soon as a bound is set.
    """
    ranged = F.coalesce("own_last_timestamp", "first_timestamp", "event_time")
    rows = filters.where_if(rows, within(ranged, since, until))
    rows = filters.in_namespaces(rows, options.namespace_list(namespaces))
    rows = filters.member(rows, "event_type", event_types)
    rows = filters.member(rows, "object_kind", object_kinds)
    rows = filters.member(rows, "object_name", object_names)
    rows = filters.member(rows, "source_component", source_components)
    rows = filters.where_if(rows, filters.has_labels(options.label_terms(label_selectors)))
    rows = filters.search(rows, "message", options.pattern("message_pattern", message_pattern))
    return filters.search(rows, "reason", options.pattern("reason_pattern", reason_pattern))


def events_of_namespace(rows: DataFrame, namespace: str) -> DataFrame:
    """Events about objects in one namespace."""
    return rows.where((F.col("involved_namespace") == namespace) & (F.col("namespace") == namespace))


FIRST_ARRIVAL = [
    "namespace",
    "event_type",
    "reason",
    "message",
    "object_kind",
    "object_name",
    "object_uid",
    "source_component",
    "source_host",
    "first_timestamp",
    "timestamp",
    "cluster_name",
]


#: what merging reads of an event
MERGED_COLUMNS = ("deduplication_key", *FIRST_ARRIVAL, "last_timestamp", "count")


def needed_for(event_filters: Mapping[str, object]) -> list[str]:
    """The columns that merging and the given filters read."""
    used = [c for f, value in event_filters.items() if value for c in FILTER_COLUMNS.get(f, ())]
    return [*MERGED_COLUMNS, *used]


def first_and_last(rows: DataFrame, order: Sequence[Column | str], unique: bool = False) -> DataFrame:
    """(deduplication_key, first, last_timestamp, count) of landed events.

    Describing columns come from the first arrival, counts add up, and the last time is
    that of the latest arrival which has one.  Rows arriving together are ordered by
    content, so a rerun gives the same result; ``unique`` states that none do.  Rows are stored
    once and fetched by number: all aggregations are of fixed width and combine before the shuffle.
    """
    if unique:
        placed = ranked(rows, "events", order, MERGED_COLUMNS)
        return _described(placed, _facts_by_place(placed))
    placed = numbered(rows, "events", order, MERGED_COLUMNS)
    key = ["deduplication_key"]
    tie = F.xxhash64(*FIRST_ARRIVAL)
    narrow = placed.select(*key, "last_timestamp", "count", POSITION, ROW, tie.alias("tie"))
    narrow = stored(narrow, "event-keys")
    facts = narrow.groupBy(*key).agg(F.sum("count").alias("total"))
    first = tied(narrow, key).groupBy(*key).agg(least_row(F.col("tie")).alias(ROW))
    dated = narrow.where(F.col("last_timestamp").isNotNull())
    last = tied(dated, key, last=True).groupBy(*key).agg(F.max("last_timestamp").alias("last"))
    return _described(placed, first.join(facts, key).join(last, key, "left").select(ROW, "total", "last"))


def first_and_last_numbered(rows: DataFrame, number: str) -> DataFrame:
    """As :func:`first_and_last` of rows that are stored already, each under its ``number`` in the order of arrival."""
    placed = rows.withColumns({ROW: F.col(number), RANK: F.lit(0), AT: F.col(number)})
    return _described(placed, _facts_by_place(placed))


def _facts_by_place(placed: DataFrame) -> DataFrame:
    """(ROW of the first arrival, last, total) per key, of rows whose places differ.

    Numbers are compared within a file's split; what is left per key and split is few.
    """
    key = ["deduplication_key"]
    dated = F.when(F.col("last_timestamp").isNotNull(), F.col(AT))
    split = placed.groupBy(*key, RANK).agg(
        F.min_by(ROW, AT).alias(ROW),
        F.min(AT).alias("first_at"),
        F.max_by("last_timestamp", dated).alias("last"),
        F.max(dated).alias("last_at"),
        F.sum("count").alias("total"),
    )
    first_at, last_at = (side_by_side(F.col(RANK), F.col(c)) for c in ("first_at", "last_at"))
    facts = split.groupBy(*key).agg(
        F.min_by(ROW, first_at).alias(ROW),
        F.max_by("last", last_at).alias("last"),
        F.sum("total").alias("total"),
    )
    return facts.select(ROW, "total", "last")


def _described(placed: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts of keys with the columns of their first arrival."""
    described = placed.select(ROW, "deduplication_key", F.struct(*FIRST_ARRIVAL).alias("first"))
    return by_number(described, facts, "inner", "event-facts").select(
        "deduplication_key", "first", F.col("last").alias("last_timestamp"), F.col("total").alias("count")
    )


def merge_landed(rows: DataFrame, order: Sequence[Column | str], unique: bool = False) -> DataFrame:
    """One row per merge key of landed events."""
    return merged_rows(first_and_last(rows, order, unique))


def merge_events(rows: DataFrame, seq: Column) -> DataFrame:
    """One row per merge key, as one aggregation that a stream can keep as its state.

    ``seq`` is the arrival order; the result is that of :func:`merge_landed`.
    """
    order = F.struct(seq.alias("seq"), F.xxhash64(*FIRST_ARRIVAL).alias("tie"))
    dated = F.when(F.col("last_timestamp").isNotNull(), order)
    merged = rows.groupBy("deduplication_key").agg(
        F.min_by(F.struct(*FIRST_ARRIVAL), order).alias("first"),
        F.max_by("last_timestamp", dated).alias("last_timestamp"),
        F.sum("count").alias("count"),
    )
    return merged_rows(merged)


def merged_rows(merged: DataFrame) -> DataFrame:
    """Table columns of merged events: ``first`` describes, the last time is shown."""
    return merged.select(
        *[F.col(f"first.{c}").alias(c) for c in FIRST_ARRIVAL if c != "timestamp"],
        F.coalesce("last_timestamp", "first.timestamp").alias("timestamp"),
        "last_timestamp",
        "count",
        "deduplication_key",
    )


def arrival_order() -> Column:
    """Order by the object's own version, then by event time.

    For inputs without a line position, such as streams, whose files may be read
    in any order.
    """
    version = F.col("resource_version").try_cast("long")
    return F.struct(version, F.coalesce("last_timestamp", "first_timestamp"))


def own_order() -> Column:
    """The same order as one fixed-width number; a missing version or time comes first."""
    version, time = F.col("resource_version").try_cast("long"), F.coalesce("last_timestamp", "first_timestamp")
    micros = F.coalesce(F.unix_micros(time) + F.lit(1 << 60), F.lit(0))
    return side_by_side(F.coalesce(version, F.lit(-(1 << 62))), micros)


def cluster_events(
    lines: DataFrame,
    *,
    order: Sequence[str] | None = None,
    as_of: dt.datetime | None = None,
    since: dt.datetime | None = None,
    lookback: str | None = None,
    limit: int | None = None,
    cluster_name: str = "",
    watch: bool = False,
    **event_filters,
) -> DataFrame:
    """``cluster_events`` rows: parsed, filtered, merged, cut to ``limit``.

    ``order`` names the line columns that give the arrival order: by default the
    place in the files or ``line_no``, else the objects' own order.
    """
    options.non_negative("limit", limit)
    start = resolve_since(since, lookback, as_of)
    unique = False
    if order is None:
        if "file_path" in lines.columns:
            unique = "line_no" not in lines.columns
            lines = number_lines(lines)
        order = place_of(lines) if "line_no" in lines.columns else []
    needed = needed_for({**event_filters, "since": start})
    if not order:
        needed.append("resource_version")
    parsed = parse_events(
        lines, as_of=as_of, cluster_name=cluster_name, keep=order, watch=watch, columns=needed
    )
    rows = filter_events(parsed, since=start, **event_filters)
    merged = merge_landed(rows, order or [own_order()], unique)
    merged = filters.first_rows(merged, ["deduplication_key"], limit)
    return schemas.conform(
        with_source(merged, SOURCE_TYPE, cluster_name), schemas.CLUSTER_EVENTS
    )
