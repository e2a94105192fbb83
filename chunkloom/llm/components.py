"""Connected components of links by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's greater (``large``) or smaller neighbours on the least node it sees."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for each node of ``links``, the component being its least node.

    Nulls and loops are left out; repeated links change nothing. The number of rounds grows with the
    logarithm of the longest chain; links that are stars already take none. Each round is checkpointed.
    """
    edges = cut(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct())
    while not _stars(edges):
        edges = cut(_star(_star(edges, True).where("u <> v").distinct(), False).where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one node that hangs on none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 OR hangs = 1 AND holds = 1").isEmpty()
