"""Connected components by alternating large-star and small-star steps.

Every step is two aggregations and a join on written tables: no node's
neighbours are ever collected, hub joins are left to adaptive skew splitting,
and the number of rounds grows with the logarithm of the longest path.  The
rounds end when every node points at one centre that itself points nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haven.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def _unfinished(e: DataFrame) -> DataFrame:
    """Nodes that keep ``e`` from being stars: lower ends of several edges, or of one and centre of another."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("low")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("low")))
    return (ends.groupBy("node").agg(F.sum("low").alias("low"), F.min("low").alias("least"))
            .filter("low > 1 or (low = 1 and least = 0)"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node on an edge; component is its smallest
    reachable node.  ``edges`` is (u, v) with u <> v, either way round; nodes
    without an edge are not listed."""
    e = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .filter("u <> v").distinct(), name)
    while True:
        e = written(_small_star(_large_star(e)), name)
        if _unfinished(e).isEmpty():
            break
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()) \
        .groupBy("node").agg(F.min("component").alias("component"))
