"""Status rules of cluster objects, as expressions over parsed counters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def replica_status(wanted: Column, ready: Column) -> Column:
    """NULL unless both counters are present."""
    return F.when(
        wanted.isNotNull() & ready.isNotNull(),
        F.when(ready == 0, "Pending").when(ready < wanted, "Updating").otherwise("Ready"),
    )


def deployment_status(conditions: Column, replicas: Column, ready: Column) -> Column:
    """The first decisive condition in list order, else the replica rule."""

    def verdict(c: Column) -> Column:
        return F.when((c["type"] == "Available") & (c["status"] == "True"), "Ready").when(
            (c["type"] == "Progressing") & (c["status"] == "False"), "Failed"
        )

    decisive = F.filter(F.transform(conditions, verdict), lambda v: v.isNotNull())
    return F.coalesce(
        F.get(decisive, F.lit(0)), replica_status(replicas, ready), F.lit("Unknown")
    )


def scaled_status(wanted: Column, ready: Column) -> Column:
    return F.coalesce(replica_status(wanted, ready), F.lit("Unknown"))


def generic_status(phase: Column, state: Column) -> Column:
    return F.coalesce(phase, state, F.lit("Active"))
