"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authwatch.llm.batches import keep_table


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least v of each u: combined before the shuffle, then joined,
    so that a node with very many edges stays split."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_least_neighbour(both).filter(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))
    near = _least_neighbour(large.filter(F.col("u") > F.col("v")))
    return (near.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"),
                                                         F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v"))).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or points at one centre only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    return (ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
            .filter("out > 1 or (out = 1 and into = 1)").isEmpty())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (long ids) but the roots, the least of their
    component. Each round is kept as a table, and rounds end when all edges form stars."""
    current = keep_table(edges.filter(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct())
    while not _are_stars(current):
        current = keep_table(_star(current))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
