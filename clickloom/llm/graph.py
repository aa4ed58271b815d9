"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a group-by with map-side combine and an equi-join, so a vertex with a third of
all edges is split by AQE; nothing is collected. Each round is written to the shared folder and
read back, which cuts the lineage and lets a lost executor's work be redone from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.llm.tables import stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest vertex around it."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    joined = both.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows ``(a, b)`` in, rows ``(id, root)`` out: for every vertex that is not the smallest
    of its component, that smallest vertex.

    Self-loops, nulls, repeated and reversed edges are allowed and change nothing; an empty
    table gives an empty table.
    """
    current = stage(_small_star(edges.select("a", "b").where("a <> b").distinct()))
    while not _settled(current):
        current = stage(_small_star(_large_star(current)))
    return current.select(F.col("a").alias("id"), F.col("b").alias("root"))


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex on the left has one edge, and none of them stands on the right: then
    the edges are stars, one per component, around its smallest vertex."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not several.isEmpty():
        return False
    left = edges.select(F.col("a").alias("b"))
    return edges.join(left, "b", "left_semi").isEmpty()
