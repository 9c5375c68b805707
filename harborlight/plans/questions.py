"""Operational and security questions over the registered tables.

A question names a table, the rows it is about, the columns it shows and the time that
sorts its answer, newest first.  Questions about recent rows are asked as of a moment, so
that answers can be repeated; they also restrict the day column the tables are stored
by, which keeps older days from being read at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlight.functions.times import instant, utc

DAY = "tp_date"

# What the questions look for.
ERROR_LEVEL = "ERROR"
BACKOFF = ("BackOff", "Warning")
DENIED_CODES = [401, 403]
READING_VERBS = ["get", "list"]
CHANGING_VERBS = ["create", "update", "patch", "delete"]
MACHINE_USERS = "system:"
ESCALATING_URIS = ["/escalate", "/bind"]
BINDING_RESOURCES = ["clusterrolebindings", "rolebindings"]
INTERACTIVE_SUBRESOURCES = ["exec", "portforward", "attach"]


@dataclass(frozen=True)
class Question:
    table: str
    about: Callable[[], Column]
    shows: tuple[str, ...]
    newest_by: str | None = None
    #: only rows younger than this, by ``newest_by``
    recent: dt.timedelta | None = None
    #: answers with a count per value of the shown columns instead of rows
    counted_as: str | None = None


def _col(name: str) -> Column:
    return F.col(name)


_HOUR = dt.timedelta(hours=1)
_WHO = ("stage_timestamp", "user_name")
_OBJECT = ("namespace", "name", "response_code")

QUESTIONS = {
    "recent_errors": Question(
        "pod_logs",
        lambda: _col("log_level") == ERROR_LEVEL,
        ("timestamp", "namespace", "pod_name", "log_message"),
        "timestamp",
        _HOUR,
    ),
    "backoff_warnings": Question(
        "cluster_events",
        lambda: (_col("reason") == BACKOFF[0]) & (_col("event_type") == BACKOFF[1]),
        ("namespace", "object_name", "message", "count"),
        "last_timestamp",
    ),
    "pods_per_namespace": Question(
        "cluster_resources",
        lambda: _col("resource_type") == "Pod",
        ("namespace",),
        counted_as="pod_count",
    ),
    "failed_authentication": Question(
        "audit_logs",
        lambda: _col("response_code").isin(DENIED_CODES),
        (*_WHO, "source_ips", "request_uri", "response_code"),
        "stage_timestamp",
        _HOUR,
    ),
    "secret_access": Question(
        "audit_logs",
        lambda: (_col("resource") == "secrets") & _col("verb").isin(READING_VERBS),
        (*_WHO, "verb", *_OBJECT),
        "stage_timestamp",
    ),
    "human_admin_changes": Question(
        "audit_logs",
        lambda: _col("verb").isin(CHANGING_VERBS) & ~_col("user_name").startswith(MACHINE_USERS),
        (*_WHO, "verb", "resource", *_OBJECT),
        "stage_timestamp",
    ),
    "privilege_escalation": Question(
        "audit_logs",
        lambda: _any(_col("request_uri").contains(part) for part in ESCALATING_URIS)
        | _col("resource").isin(BINDING_RESOURCES),
        (*_WHO, "request_uri", "source_ips", "response_code"),
        "stage_timestamp",
    ),
    "interactive_access": Question(
        "audit_logs",
        lambda: _col("subresource").isin(INTERACTIVE_SUBRESOURCES),
        (*_WHO, "namespace", "name AS pod_name", "subresource", "source_ips"),
        "stage_timestamp",
    ),
}


def _any(tests) -> Column:
    first, *others = tests
    for test in others:
        first = first | test
    return first


def ask(spark: SparkSession, question: str, as_of: dt.datetime | None = None) -> DataFrame:
    """The answer to a named question over the registered tables."""
    wanted = QUESTIONS[question]
    rows = spark.table(wanted.table)
    if wanted.recent is not None:
        moment = utc(as_of) if as_of is not None else dt.datetime.now(dt.timezone.utc)
        start = moment - wanted.recent
        if DAY in rows.columns:
            # a row's day is that of its time, where it has one; others cannot be recent
            rows = rows.where(F.col(DAY) >= F.lit(start.date()))
        rows = rows.where(F.col(wanted.newest_by) > instant(start))
    rows = rows.where(wanted.about())
    if wanted.counted_as:
        return rows.groupBy(*wanted.shows).agg(F.count(F.lit(1)).alias(wanted.counted_as))
    if wanted.newest_by:
        rows = rows.orderBy(F.desc(wanted.newest_by))
    return rows.selectExpr(*wanted.shows)
