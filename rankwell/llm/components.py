"""Connected components of a large edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwell.llm.common import materialize


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", node: str = "fp") -> DataFrame:
    """Per node of the edges: the node and `root`, the least node of its component.

    Each round turns every node's larger neighbours to its least one, then its smaller ones, until nothing moves;
    the number of rounds grows with the logarithm of the longest path. Every round is written to the shared folder,
    so lost executors cost one round. The pairs are aggregated by node with partial sums; a node with very many
    neighbours is one key of a min(), never one list.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u > v").distinct()
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        pairs = materialize(small.filter("u != v").distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", node)
    return roots.unionByName(roots.select(F.col("root").alias(node), "root").distinct())
