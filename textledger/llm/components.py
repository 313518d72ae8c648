"""Connected components of a large edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, shuffled


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(shuffled(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(shuffled(least), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(spark: SparkSession, edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node with an edge, except roots themselves; root is the smallest node reachable.

    ``edges`` has two long columns, in any order and repeated at will; null ends and loops
    are ignored, no edges give no rows. Each round is written to the shared folder, which cuts
    the lineage; the driver sees only a count and a checksum. A hub's edges meet its minimum
    in an equi-join with one row per node, which adaptive execution can split.
    """
    a, b = (F.col(c) for c in edges.columns)
    ordered = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b))
    scratch = Scratch(spark, name)
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    current = scratch.keep(ordered.distinct())
    before = mark(current)
    while before[0]:
        current = scratch.keep(_small_star(_large_star(current)))
        scratch.drop_before_last()
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
