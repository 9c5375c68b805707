"""Source columns added to every collected row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.functions.times import instant


def with_source(
    df: DataFrame,
    source_type: str,
    cluster_name: str = "",
    collected_at: dt.datetime | None = None,
) -> DataFrame:
    """Source name is the cluster's, or the source type for an unnamed cluster."""
    now = instant(collected_at) if collected_at is not None else F.current_timestamp()
    return df.withColumns(
        {
            "tp_source_name": F.lit(cluster_name or source_type),
            "tp_source_type": F.lit(source_type),
            "tp_collected_at": now,
        }
    )
