"""The four tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from harborlight.operators import audit, events, podlogs, resources

# Table name → the id its rows carry as source type, which is also accepted as
# a table name.
TABLES = {
    "pod_logs": podlogs.SOURCE_TYPE,
    "cluster_events": events.SOURCE_TYPE,
    "cluster_resources": resources.SOURCE_TYPE,
    "audit_logs": audit.SOURCE_TYPE,
}


def register_views(**tables: DataFrame) -> list[str]:
    """Register any of the four tables under both of its names."""
    names = []
    for table, df in tables.items():
        if table not in TABLES:
            raise ValueError(f"unknown table {table!r}; tables are {', '.join(TABLES)}")
        for name in (table, TABLES[table]):
            df.createOrReplaceTempView(name)
            names.append(name)
    return names
