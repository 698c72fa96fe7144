"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtable.llm.common import settle


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, label): label is the least node of the component. Only nodes with an edge appear.

    Each step is a grouped minimum and a join, so a node with many neighbours is combined on the map side and its join
    can be split; nothing is collected but a count. Every step ends in a checkpoint. Loops, repeated and null edges
    are ignored; no edges give no rows.
    """
    e = settle(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if not e.take(1):
        return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = large.distinct()
        small = _least(large)
        e = settle(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        before = now
