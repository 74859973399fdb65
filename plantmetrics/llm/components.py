"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.common import cut


def _linked(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``node, root``: every node that has an edge to another node, with
    the least node of its component.

    Both steps only take minima by node and join them back, so no neighbourhood is gathered
    anywhere. Each round is cut by a checkpoint; rounds grow with the logarithm of the longest
    path. The driver sees two sums a round."""
    edges = cut(_linked(edges))
    before = None
    while True:
        told = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(told) == before or not told[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = tuple(told)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _linked(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(_linked(small.unionByName(least.select("a", F.col("m").alias("b")))))
