"""Connected components by alternating large-star and small-star steps.

Both steps are a minimum per node (a partially aggregated ``groupBy``) joined back to the edges, so no
neighbour list is ever gathered: a node of any degree is spread over tasks by the skew-join split.
The edge list of each round is written to the shared folder; the driver sees only a count and a sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge of ``edges`` that is not its component's least node.

    Loops, repeats and both directions are allowed; edges with a null end are ignored. No edges
    give no rows.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = scratch(
        edges.where(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .distinct()
    )
    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = state(now)
    while seen[0]:
        now = scratch(_small_star(_large_star(now)))
        was, seen = seen, state(now)
        if was == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
