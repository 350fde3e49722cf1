"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; component is the smallest
    node reachable.

    Each round rewires the forest: every node hangs itself and its neighbours on
    its smallest neighbour (large-star / small-star contraction), so the depth
    halves and rounds grow with the logarithm of the diameter.  Hot nodes are
    pre-aggregated by the map-side ``min``.  No edge leaves the cluster; the driver sees
    only a count per round.
    """
    e = stored(edges.select("u", "v").where("u <> v").distinct(), f"{name}-e")
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of u hang on the minimum of its neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: smaller neighbours and u itself hang on the minimum
        down = large.where("u <> v").distinct()
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))))
        nxt = stored(small.where("u <> v").distinct(), f"{name}-e")
        # done when every node has one parent and no parent has a parent itself
        parents = nxt.groupBy("u").agg(F.count("*").alias("n"))
        unstable = (parents.where("n > 1").select("u")
                    .unionByName(nxt.select(F.col("v").alias("u")).distinct().join(parents, "u", "left_semi")))
        e = nxt
        if unstable.isEmpty():
            break
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
