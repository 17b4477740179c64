"""Connected components of large graphs by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelspark.session import materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) -> (node, component): the smallest node each can reach; nodes without edges are absent.

    Every round links the larger neighbours of a node to its smallest one, then the smaller ones;
    rounds grow with the logarithm of the nodes. Minima are combined before the shuffle and joined
    back, so a node with very many edges is split like any skewed join key. Each round is written
    to the shared folder.
    """
    named = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    now = materialise(named.where("u < v").distinct())
    seen = _signature(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))
        smallest = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(smallest, "u")
        small = joined.select(F.col("m").alias("u"), "v").unionByName(joined.select(F.col("m").alias("u"), F.col("u").alias("v")))
        now = materialise(small.where("u < v").distinct())
        last, seen = seen, _signature(now)
        if last == seen:
            break
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots).distinct()
