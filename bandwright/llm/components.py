"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import remove, stage, staged


def _larger_to_smaller(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return ends.where(F.col("u") != F.col("v")).distinct()


def _both_ways(rows: DataFrame, *edges: Column) -> DataFrame:
    return rows.select(F.explode(F.array(*edges)).alias("edge")).select("edge.u", "edge.v")


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """`node` and `label`, the smallest node reachable, for every node that has an edge to another one.

    Each round points all neighbours of a node at its smallest one; rounds grow with the logarithm of the longest
    path. Edges of a node with very many neighbours are counted by partial aggregation and joined to one row, a
    join that adaptive execution can split. Only a count and a checksum per round reach the driver.
    """
    spark = edges.sparkSession
    stars, path = stage(_larger_to_smaller(edges.select(F.col(left).alias("u"), F.col(right).alias("v"))), "components")
    before = None
    while True:
        seen = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 32)).alias("sum")).first()
        if seen == before:
            break
        before = seen
        both = _both_ways(stars, F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _both_ways(
            large.join(least, "u"),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")),
        )
        last = path
        stars, path = stage(_larger_to_smaller(small), "components")
        remove(spark, last)
    ends = F.struct(F.col("u").alias("node"), F.col("v").alias("label"))
    centre = F.struct(F.col("v").alias("node"), F.col("v").alias("label"))
    nodes = stars.select(F.explode(F.array(ends, centre)).alias("at")).select("at.node", "at.label").distinct()
    return staged(nodes, "components-nodes")
