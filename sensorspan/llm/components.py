"""Connected components of a graph of any size, by joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """Of ``edges`` (a, b), undirected: every node with the least node of its component.

    Returns node, root. Alternating stars: in the large step every node hands
    its larger neighbours to the least of its neighbourhood, in the small step
    its smaller ones, until nothing changes; what is left are stars around the
    least nodes. Each step is one aggregation and one join on the node, whose
    hot keys the planner can split. Loops, repeated edges and nulls are
    ignored. No edges give no rows.
    """
    ends = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    state = saved(ends.where("high > low").distinct())
    digest = None
    while True:
        both = state.select("high", "low").union(state.select(F.col("low"), F.col("high"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
        large = (
            both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low"))
        ).distinct()
        below = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(below, "high")
        small = small.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
            small.select("high", F.col("least").alias("low"))
        )
        state = saved(small.where("high > low").distinct())
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if now == digest:
            break
        digest = now
    roots = state.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.union(state.select(F.col("low"), F.col("low")).distinct())
