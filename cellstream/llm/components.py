"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(v as decimal(20, 0)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that isn't the smallest of its component.

    edges: columns u, v (long), in any direction, repeats and loops allowed. Each step is one
    minimum per node (combined before the shuffle) joined back to the edges, so a hub's edges
    are never gathered in one row; every round is checkpointed. No edges give no rows.
    """
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = _signature(e)
    while seen[0]:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
