"""Connected components of a graph of pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import stored


def components(pairs: DataFrame) -> DataFrame:
    """node, root (smallest node of its component, another than itself) for pairs (a, b).

    Large-star and small-star steps in turn: every edge moves towards the
    smallest neighbour until only stars are left. Each round is written to the
    shared folder; minima are aggregated before their shuffle and joins are left
    to adaptive execution, so a hub is split.
    """
    ordered = pairs.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = stored(ordered.distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(
            edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
        )
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x and y > m").select(F.col("y").alias("v"), F.col("m").alias("u"))
        large = large.distinct()
        lowest = large.groupBy("v").agg(F.min("u").alias("m"))
        moved = large.join(lowest, "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        kept = lowest.select("v", F.col("m").alias("u"))
        edges = stored(moved.unionByName(kept).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
        before = state
