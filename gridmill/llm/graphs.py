"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from gridmill.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node reachable) for every node of ``edges`` (a, b); nodes are longs.

    Alternating large-star and small-star steps: each is a grouped minimum, which combines before its shuffle, and a join
    back, whose large groups adaptive execution cuts. Links never pass through the driver. Lineage is cut in the shared folder.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        linked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        # Count and sum of the links are taken while they are written.
        seen = Observation()
        now = checkpointed(linked.where("u > v").distinct().observe(
            seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("total")))
        state = seen.get
        if state == before or not state["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        before = state
