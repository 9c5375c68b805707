"""API object dumps → ``cluster_resources`` rows."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight import schemas
from harborlight.functions.status import deployment_status, generic_status, scaled_status
from harborlight.functions.members import Members, chosen, parse
from harborlight.functions.strict_json import (
    is_object,
    pick,
    pick_bool,
    pick_number,
    reads_as_other,
    strict_str,
    whole,
)
from harborlight.functions.text import empty_to_null, is_blank, or_empty
from harborlight.functions.times import parse_rfc3339, resolve_since, within
from harborlight.operators import filters, options
from harborlight.operators.enrich import with_source
from harborlight.operators.lookup import newest, version_order
from harborlight.operators.winners import stored

SOURCE_TYPE = "kubernetes_resources"

# Registered kinds, and the short names kinds can be listed by.
KINDS = [
    "Pod",
    "Service",
    "ConfigMap",
    "Secret",
    "PersistentVolume",
    "PersistentVolumeClaim",
    "Deployment",
    "StatefulSet",
    "DaemonSet",
    "Ingress",
    "NetworkPolicy",
]
SHORT_NAMES = {
    "svc": "Service",
    "deploy": "Deployment",
    "rs": "ReplicaSet",
    "cm": "ConfigMap",
}
_LISTABLE = [*KINDS, "ReplicaSet"]

_CONDITION_FIELDS = "type string, status string, reason string, message string"
# Resource versions are strings of digits, which only a VARIANT leaf keeps apart
# from numbers at no extra parse.
_OBJECT_FIELDS = (
    "kind string, type string, data map<string,string>,"
    " metadata struct<name string, namespace string, uid string, resourceVersion variant,"
    " creationTimestamp string, labels map<string,string>, annotations map<string,string>,"
    " ownerReferences array<variant>>,"
    " spec struct<nodeName string, type string, clusterIP string, externalIPs array<string>,"
    " replicas double, storageClassName string, volumeMode string,"
    " accessModes array<string>, ingressClassName string>,"
    " status struct<phase string, state string, podIP string, qosClass string,"
    " containerStatuses array<struct<restartCount double>>,"
    f" conditions array<struct<{_CONDITION_FIELDS}, lastTransitionTime string>>,"
    " replicas double, readyReplicas double, updatedReplicas double,"
    " availableReplicas double, unavailableReplicas double,"
    " desiredNumberScheduled double, currentNumberScheduled double, numberReady double,"
    " updatedNumberScheduled double, numberAvailable double, numberUnavailable double,"
    " loadBalancer struct<ingress array<variant>>>"
)
_NOTHING_OPEN = "{}"


def resource_kinds(names: Iterable[str]) -> list[str]:
    """Kind names for exact, plural or short names; unknown ones are skipped with a warning."""
    kinds = []
    for name in names:
        lower = name.lower()
        known = [k for k in _LISTABLE if lower in (k.lower(), k.lower() + "s")]
        if name in _LISTABLE:
            kinds.append(name)
        elif lower in SHORT_NAMES:
            kinds.append(SHORT_NAMES[lower])
        elif known:
            kinds.append(known[0])
        else:
            warnings.warn(f"unsupported resource type {name!r} is skipped", stacklevel=2)
    return kinds


def owner_references(items: Column) -> Column:
    """Object elements as structs; the controller flag stays NULL when absent."""
    return F.transform(
        F.filter(items, is_object),
        lambda r: F.struct(
            or_empty(pick(r, "apiVersion")).alias("api_version"),
            or_empty(pick(r, "kind")).alias("kind"),
            or_empty(pick(r, "name")).alias("name"),
            or_empty(pick(r, "uid")).alias("uid"),
            pick_bool(r, "controller").alias("controller"),
        ),
    )


def _of_variants(items: Column, member: Callable[[Column, str], Column]) -> Column:
    return F.transform(F.filter(items, is_object), lambda c: _condition(c, member))


def _condition(c: Column, member: Callable[[Column, str], Column]) -> Column:
    return F.named_struct(
        F.lit("type"),
        or_empty(member(c, "type")),
        F.lit("status"),
        or_empty(member(c, "status")),
        F.lit("reason"),
        empty_to_null(member(c, "reason")),
        F.lit("message"),
        empty_to_null(member(c, "message")),
        F.lit("last_transition_time"),
        parse_rfc3339(member(c, "lastTransitionTime")),
    )


def conditions(m: Members) -> Column:
    """Object elements of the status conditions as structs, in list order.

    Lists of plain text are used as parsed; anything else is read again with
    its types.
    """
    if m.is_open("status.conditions"):
        return _of_variants(m.variants("status.conditions"), pick)
    items = m.raw("status.conditions")

    def odd(c: Column) -> Column:
        leaves = [c[f.split()[0]] for f in _CONDITION_FIELDS.split(", ")]
        found = [F.coalesce(reads_as_other(x), F.lit(False)) for x in leaves]
        return c.isNull() | found[0] | found[1] | found[2] | found[3]

    plain = F.transform(items, lambda c: _condition(c, lambda x, name: x[name]))
    typed = _of_variants(m.variants("status.conditions"), pick)
    return F.when(~F.exists(items, odd), plain).otherwise(typed)


def _restarts(m: Members) -> Column:
    """Sum over container statuses; missing or non-numeric counts add nothing."""

    def add(count: Callable[[Column], Column]):
        return lambda total, status: total + F.coalesce(whole(count(status)), F.lit(0))

    # a list with elements that are no objects does not fit the declared type
    typed = F.aggregate(
        m.variants("status.containerStatuses"),
        F.lit(0),
        add(lambda s: pick_number(s, "restartCount")),
    )
    if m.is_open("status.containerStatuses"):
        return F.coalesce(typed, F.lit(0))
    plain = F.aggregate(
        m.raw("status.containerStatuses"), F.lit(0), add(lambda s: s["restartCount"])
    )
    return F.coalesce(plain, typed, F.lit(0))


def _replicas(m: Members, desired: Column, *rest: str | None) -> Column:
    """The six counters, 0 where a kind does not report one."""
    names = ["current", "ready", "updated", "available", "unavailable"]
    paths = [*rest, *[None] * (len(names) - len(rest))]
    counters = [F.lit(0) if p is None else F.coalesce(m.count(p), F.lit(0)) for p in paths]
    return F.struct(
        F.coalesce(desired, F.lit(0)).alias("desired"),
        *[c.alias(n) for n, c in zip(names, counters, strict=True)],
    )


def _has_status(m: Members) -> Column:
    """``status`` is an object; asking for it declares nothing below it by itself."""
    if m.is_open("status"):
        return is_object(m.raw("status"))
    m.raw("status.phase")
    return F.col("doc.status").isNotNull()


def _replicas_by_kind(m: Members, kind: Column) -> Column:
    """Only objects with a status report replicas."""
    deployment = _replicas(
        m,
        F.coalesce(m.count("status.replicas"), m.count("spec.replicas")),
        "status.replicas",
        "status.readyReplicas",
        "status.updatedReplicas",
        "status.availableReplicas",
        "status.unavailableReplicas",
    )
    stateful = _replicas(
        m,
        m.count("spec.replicas"),
        "status.replicas",
        "status.readyReplicas",
        "status.updatedReplicas",
    )
    daemon = _replicas(
        m,
        m.count("status.desiredNumberScheduled"),
        "status.currentNumberScheduled",
        "status.numberReady",
        "status.updatedNumberScheduled",
        "status.numberAvailable",
        "status.numberUnavailable",
    )
    return F.when(
        _has_status(m),
        F.when(kind == "Deployment", deployment)
        .when(kind == "StatefulSet", stateful)
        .when(kind == "DaemonSet", daemon),
    )


def _status_by_kind(m: Members, kind: Column) -> Column:
    """Kinds whose status comes from ``status`` report empty text without one."""
    phase = or_empty(m.text("status.phase"))
    has_status = _has_status(m)
    ingress = (
        m.variants("status.loadBalancer.ingress")
        if m.is_open("status")
        else m.raw("status.loadBalancer.ingress")
    )
    balanced = F.size(ingress) > 0
    scaled = scaled_status(m.count("status.replicas"), m.count("status.readyReplicas"))
    daemon = scaled_status(
        m.count("status.desiredNumberScheduled"), m.count("status.numberReady")
    )
    rolled_out = deployment_status(
        conditions(m),
        m.count("status.replicas"),
        m.count("status.readyReplicas"),
    )

    def given(status: Column) -> Column:
        return F.when(has_status, status).otherwise("")

    return (
        F.when(kind.isin("Pod", "PersistentVolume", "PersistentVolumeClaim"), phase)
        .when(kind.isin("Service", "ConfigMap", "Secret", "NetworkPolicy"), "Active")
        .when(kind == "Deployment", given(rolled_out))
        .when(kind == "StatefulSet", given(scaled))
        .when(kind == "DaemonSet", given(daemon))
        .when(kind == "Ingress", F.when(balanced, "Ready").otherwise("Active"))
        .otherwise(generic_status(m.text("status.phase"), m.text("status.state")))
    )


def _status_details(m: Members, kind: Column) -> Column:
    """The status object; for key-value kinds only the number of keys (and secret type)."""
    summary = F.struct(
        F.array_size(F.map_keys(m.raw("data"))).alias("data_keys_count"),
        F.when(kind == "Secret", m.text("type")).alias("type"),
    )
    # the map size of a missing "data" is NULL, and to_json leaves NULLs out
    counted = F.parse_json(F.to_json(summary))
    status = m.raw("status")
    return F.when(kind.isin("ConfigMap", "Secret"), counted).when(
        kind.isin([*KINDS]) & is_object(status), status
    )


def parse_resources(
    objects: DataFrame,
    *,
    cluster_name: str = "",
    text: str = "value",
    include_spec: bool = False,
    include_status: bool = False,
    include_owner_refs: bool = False,
    newest_only: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per API object that has metadata.

    With ``newest_only`` an object that several dumps hold counts as its newest version:
    latest dump, then highest resource version.

    Only members that ``columns`` (all by default) need are parsed, once; the other columns
    are NULL.  Specs, status details with conditions, and owner references are read only on
    request.  Values of key-value objects are never projected.
    """
    opened = [*(["spec"] if include_spec else []), *(["status"] if include_status else [])]
    m = Members(_OBJECT_FIELDS, text, opened=opened)
    kind = F.col("resource_type")

    def only(kinds: Sequence[str], value: Column) -> Column:
        return F.when(kind.isin(list(kinds)), value)

    def open_spec() -> Column:
        spec = m.raw("spec")
        return F.when(is_object(spec), spec).otherwise(F.parse_json(F.lit(_NOTHING_OPEN)))

    volumes = ["PersistentVolume", "PersistentVolumeClaim"]
    builders: dict[str, Callable[[], Column]] = {
        "namespace": lambda: or_empty(m.text("metadata.namespace")),
        "resource_type": lambda: kind,
        "resource_name": lambda: or_empty(m.text("metadata.name")),
        "status": lambda: _status_by_kind(m, kind),
        "created_at": lambda: parse_rfc3339(m.raw("metadata.creationTimestamp")),
        "labels": lambda: _map_or_empty(m.raw("metadata.labels")),
        "annotations": lambda: _map_or_empty(m.raw("metadata.annotations")),
        "node_name": lambda: or_empty(only(["Pod"], m.text("spec.nodeName"))),
        "cluster_name": lambda: F.lit(cluster_name),
        "uid": lambda: empty_to_null(m.text("metadata.uid")),
        "resource_version": lambda: empty_to_null(strict_str(m.raw("metadata.resourceVersion"))),
        "replicas": lambda: _replicas_by_kind(m, kind),
        "service_type": lambda: only(["Service"], empty_to_null(m.text("spec.type"))),
        "cluster_ip": lambda: only(["Service"], empty_to_null(m.text("spec.clusterIP"))),
        "external_ips": lambda: only(["Service"], m.texts("spec.externalIPs")),
        "ingress_class": lambda: only(["Ingress"], empty_to_null(m.text("spec.ingressClassName"))),
        "storage_class": lambda: only(volumes, empty_to_null(m.text("spec.storageClassName"))),
        "volume_mode": lambda: only(volumes, empty_to_null(m.text("spec.volumeMode"))),
        "access_modes": lambda: only(volumes, m.texts("spec.accessModes")),
        "pod_ip": lambda: only(["Pod"], empty_to_null(m.text("status.podIP"))),
        "phase": lambda: only(["Pod"], empty_to_null(m.text("status.phase"))),
        "restart_count": lambda: F.when(kind == "Pod", _restarts(m)).otherwise(0),
        "qos_class": lambda: only(["Pod"], empty_to_null(m.text("status.qosClass"))),
    }
    if include_spec:
        builders["spec"] = open_spec
    if include_status:
        builders["status_details"] = lambda: _status_details(m, kind)
        builders["conditions"] = lambda: only(
            ["Pod", "Deployment", "StatefulSet", "DaemonSet"], conditions(m)
        )
    if include_owner_refs:
        builders["owner_references"] = lambda: owner_references(m.raw("metadata.ownerReferences"))
    built = chosen(builders, columns)
    kind_text = or_empty(m.text("kind"))
    versions = chosen(builders, ["namespace", "resource_name", "resource_version"]) if newest_only else {}
    m.raw("metadata.name")  # an object without metadata is no row, whatever is asked
    parsed = parse(objects.where(~is_blank(F.col(text))), m)
    parsed = parsed.where(F.col("doc.metadata").isNotNull()).withColumn("resource_type", kind_text)
    if newest_only:
        parsed = newest(
            parsed,
            [kind, versions["namespace"], versions["resource_name"]],
            version_order(parsed, versions["resource_version"], F.col(text)),
        )
    rows = parsed.select(*[c.alias(n) for n, c in built.items()])
    return schemas.conform(rows, schemas.CLUSTER_RESOURCES)


def _map_or_empty(labels: Column) -> Column:
    return F.coalesce(labels, F.create_map().cast("map<string,string>"))


#: the columns each filter reads
FILTER_COLUMNS = {
    "since": ["created_at"],
    "until": ["created_at"],
    "namespaces": ["namespace"],
    "resource_types": ["resource_type"],
    "resource_names": ["resource_name"],
    "statuses": ["status"],
    "node_names": ["node_name"],
    "label_selectors": ["labels"],
    "name_pattern": ["resource_name"],
}


def filter_resources(
    rows: DataFrame,
    *,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    namespaces: Sequence[str] | str = (),
    resource_types: Sequence[str] = (),
    resource_names: Sequence[str] = (),
    statuses: Sequence[str] = (),
    node_names: Sequence[str] = (),
    label_selectors: Sequence[str] | str = (),
    name_pattern: str | None = None,
) -> DataFrame:
    """Keep objects that pass every given filter.

    Objects without a creation time pass the range, those without a namespace
    pass the namespace list, those without a node pass the node list.
    """
    bound = within(F.col("created_at"), since, until)
    if bound is not None:
        rows = rows.where(F.col("created_at").isNull() | bound)
    rows = filters.in_namespaces(rows, options.namespace_list(namespaces), pass_unscoped=True)
    if resource_types:
        rows = rows.where(F.col("resource_type").isin(resource_kinds(resource_types)))
    if resource_names:
        rows = filters.member(rows, "resource_name", ["", *resource_names])
    rows = filters.member(rows, "status", statuses)
    if node_names:
        rows = filters.member(rows, "node_name", ["", *node_names])
    rows = filters.where_if(rows, filters.has_labels(options.label_terms(label_selectors)))
    return filters.search(rows, "resource_name", options.pattern("name_pattern", name_pattern))


RESOURCE_ORDER = ["namespace", "resource_type", "resource_name"]


def cluster_resources(
    objects: DataFrame,
    *,
    since: dt.datetime | None = None,
    lookback: str | None = None,
    as_of: dt.datetime | None = None,
    limit: int | None = None,
    ordered: bool = True,
    cluster_name: str = "",
    include_spec: bool = False,
    include_status: bool = False,
    include_owner_refs: bool = False,
    newest_only: bool | None = None,
    columns: Sequence[str] | None = None,
    **resource_filters,
) -> DataFrame:
    """``cluster_resources`` rows in namespace, type, name order, cut to ``limit``.

    With ``columns`` only those are returned, and only what they, the order and the filters
    need is parsed.

    Landed dumps repeat objects, so of objects read from files only the newest version
    counts unless ``newest_only`` is False.

    ``ordered=False`` skips the global sort for callers that aggregate anyway.
    """
    options.non_negative("limit", limit)
    start = resolve_since(since, lookback, as_of)
    order = [*RESOURCE_ORDER, "uid"] if limit is not None else RESOURCE_ORDER if ordered else []
    needed = None
    if columns is not None:
        used = [f for f, v in {"since": start, **resource_filters}.items() if v]
        needed = [*columns, *order, *(c for f in used for c in FILTER_COLUMNS[f])]
    rows = parse_resources(
        objects,
        cluster_name=cluster_name,
        include_spec=include_spec,
        include_status=include_status,
        include_owner_refs=include_owner_refs,
        newest_only="file_path" in objects.columns if newest_only is None else newest_only,
        columns=needed,
    )
    rows = filter_resources(rows, since=start, **resource_filters)
    rows = schemas.conform(
        with_source(rows, SOURCE_TYPE, cluster_name), schemas.CLUSTER_RESOURCES
    )
    if limit is not None:
        rows = filters.first_rows(rows, order, limit)
    elif ordered:
        # stored first: the sort samples its input for the bounds, which would parse every object twice
        rows = stored(rows, "resources").orderBy(*order)
    return rows if columns is None else schemas.conform(rows, schemas.CLUSTER_RESOURCES, columns=columns)
