"""Where audit entries come from: files, API-server pods, collector pods."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from harborlight.operators import filters, options
from harborlight.operators.lookup import fits_broadcast, lookup_join
from harborlight.operators.podlogs import CONTAINER
from harborlight.sources.landed import DEFAULT_AUDIT_PATHS, first_non_empty, scan_lines

# How API-server pods and audit collector pods are labelled.
API_SERVER_NAMESPACE = "kube-system"
API_SERVER_SELECTORS = [
    "component=kube-apiserver",
    "k8s-app=kube-apiserver",
    "app=kube-apiserver",
    "tier=control-plane",
]
COLLECTOR_SELECTORS = [
    "app=audit-collector",
    "component=audit",
    "app.kubernetes.io/name=audit-logs",
]


class NoAuditEntries(LookupError):
    """No source yielded an audit entry."""


def lines_of_labelled_pods(
    lines: DataFrame,
    containers: DataFrame,
    selectors: Sequence[str],
    namespace: str | None = None,
    broadcast: bool | None = None,
) -> DataFrame:
    """Log lines of pods matching any selector.

    One predicate over all selectors, so a pod matching two is read once.
    """
    matches = [filters.has_labels(options.label_terms(s)) for s in selectors]
    pods = containers.where(reduce(lambda a, b: a | b, matches)).select(*CONTAINER)
    if namespace is not None:
        pods = pods.where(pods["namespace"] == namespace)
        lines = lines.where(lines["namespace"] == namespace)
    small = fits_broadcast(pods) if broadcast is None else broadcast
    return lookup_join(lines, pods, CONTAINER, small)


def api_server_lines(lines: DataFrame, containers: DataFrame, **kw) -> DataFrame:
    return lines_of_labelled_pods(
        lines, containers, API_SERVER_SELECTORS, API_SERVER_NAMESPACE, **kw
    )


def collector_lines(lines: DataFrame, containers: DataFrame, **kw) -> DataFrame:
    return lines_of_labelled_pods(lines, containers, COLLECTOR_SELECTORS, **kw)


def audit_from_files(
    spark: SparkSession,
    to_rows: Callable[[DataFrame], DataFrame],
    paths: Sequence[str] = (),
) -> DataFrame:
    """Rows of the first path that yields any after parsing and filtering."""
    rows = first_non_empty(_file_candidates(spark, to_rows, paths))
    if rows is None:
        raise NoAuditEntries(f"no audit entries in {list(paths) or DEFAULT_AUDIT_PATHS}")
    return rows


def _file_candidates(spark, to_rows, paths):
    return [
        partial(lambda p: to_rows(scan_lines(spark, p)), path)
        for path in (paths or DEFAULT_AUDIT_PATHS)
    ]


def collect_audit(
    spark: SparkSession,
    to_rows: Callable[[DataFrame], DataFrame],
    *,
    method: str | None = None,
    api_only: bool = False,
    audit_log_paths: Sequence[str] = (),
    container_lines: DataFrame | None = None,
    containers: DataFrame | None = None,
) -> DataFrame:
    """Files, then API-server pods, then collector pods: the first that yields rows.

    ``to_rows`` turns lines into filtered rows (:func:`operators.audit.audit_logs`
    with its options bound).  ``method`` forces one way; ``api_only`` skips files.
    """
    forced = options.audit_method(method)
    ways: dict[str, list] = {
        "file": _file_candidates(spark, to_rows, audit_log_paths),
        "apiserver": [],
        "daemonset": [],
    }
    if container_lines is not None and containers is not None:
        ways["apiserver"] = [lambda: to_rows(api_server_lines(container_lines, containers))]
        ways["daemonset"] = [lambda: to_rows(collector_lines(container_lines, containers))]
    wanted = [forced] if forced else options.AUDIT_METHODS[1 if api_only else 0 :]
    rows = first_non_empty([c for way in wanted for c in ways[way]])
    if rows is None:
        raise NoAuditEntries(f"no audit entries accessible by: {', '.join(wanted)}")
    return rows
