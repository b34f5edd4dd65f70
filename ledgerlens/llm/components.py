"""Connected components of an edge table, by repeated minimum neighbours.

Alternating large-star and small-star steps (each a grouped minimum and one join on
the node) shrink any graph to stars.  A hub of many edges is a hot join key with
one row on the other side, which adaptive execution splits; no neighbour list
is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, lowest: DataFrame) -> DataFrame:
    """Each edge (u, v) moved to (lowest neighbour of u, v), loops dropped, smaller end first."""
    moved = edges.join(lowest, "u").select(F.least("v", "m").alias("u"), F.greatest("v", "m").alias("v"))
    return moved.where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for each node that an edge (a, b) with two different ends names."""
    e = materialize(edges.where("a != b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(),
                    "edges")
    while not e.isEmpty():
        # Stars: no node has two smaller neighbours, and no centre is itself a leaf.
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(0).alias("leaf")),
                                          F.struct(F.col("v").alias("node"), F.lit(1).alias("leaf")))).alias("x")).select("x.*")
        tangled = ends.groupBy("node").agg(F.sum("leaf").alias("leaves"), F.min("leaf").alias("least")).where(
            "leaves > 1 or (leaves = 1 and least = 0)")
        if tangled.isEmpty():
            break
        # Large star: the greater neighbours of a node move to the least of the node and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(_star(both.where("v > u"), least), "edges")
        # Small star: the smaller neighbours of a node, and the node itself, move to the least of them.
        down = large.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        own = least.select(F.col("m").alias("u"), F.col("u").alias("v"))
        e = materialize(_star(down, least).unionByName(own).distinct(), "edges")
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
