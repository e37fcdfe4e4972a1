"""Connected components of a distributed graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.tables import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; the root is the smallest node of the component.

    Loops, repeated edges and either direction are allowed; edges with a null end are ignored. Nodes without an
    edge are not returned. Each step takes the minimum per node (combined before the exchange) and joins it back,
    a join whose hot nodes Spark splits; no neighbourhood is ever gathered. The two steps repeat until every node
    hangs directly on its root, and each round is written to the shared scratch folder.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    ends = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    current = staged(ends.select(high.alias("u"), low.alias("v")).distinct(), "star")
    loops = edges.where("u IS NOT NULL AND u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    before = None
    while True:
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
        current = staged(_small_star(_large_star(current)), "star")
    found = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    members = found.unionByName(roots)
    return members.unionByName(loops.distinct().join(members.select("node"), "node", "left_anti"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, moves to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
