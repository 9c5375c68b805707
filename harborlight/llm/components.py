"""Connected components of an edge table, as Spark joins and aggregations.

Alternating large-star and small-star steps: each node links its larger neighbours to
the least key it sees, then each node links its smaller neighbours to their least.  The
number of edges never grows, every step is written to the shared scratch folder, and
only a count and a checksum reach the driver.  A centre that holds any share of the
edges is only ever aggregated with ``min``, which combines before the shuffle.

Defined cases: loops, null ends and repeated edges are ignored; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlight.llm.common import stored


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node with an edge in ``edges`` (a, b); root is the least node."""
    links = stored(edges.select("a", "b").filter("a <> b").distinct(), "component-edges")
    before = None
    for _ in range(most_rounds):
        links = stored(_small_star(_large_star(links)), "component-links")
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    members = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    ends = F.explode(F.array(F.col("a"), F.col("b"))).alias("a")
    moved = down.join(least, "a").select(ends, F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()
