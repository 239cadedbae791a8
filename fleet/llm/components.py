"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is a grouping and a join; nothing but two numbers per round reaches the driver. A node with very many links
is only pre-aggregated and joined with one row, so a skewed join splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleet.scratch import Scratch


def smallest_reachable(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links`` but the smallest of each component."""
    scratch = Scratch(links.sparkSession)
    larger, smaller = F.greatest(a, b), F.least(a, b)
    edges = scratch.store(links.where(F.col(a) != F.col(b)).select(larger.alias("u"), smaller.alias("v")).distinct(), "links-0")
    before, step = None, 0
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = scratch.store(large, f"large-{step}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = scratch.store(small.where("u <> v").distinct(), f"links-{step}")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(f"links-{step - 1}")
        scratch.drop(f"large-{step}")
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
