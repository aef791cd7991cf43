"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.common import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each vertex's neighbours (the larger ones, or the smaller ones) on the
    smallest vertex around it. The smallest neighbour is an aggregate and comes back by
    a join, so a vertex with very many neighbours is never gathered in one task."""
    around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    hung = around.join(least, "a").where(F.col("b") > F.col("a") if large else F.lit(True))
    out = hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of the edges (a, b), root being the smallest
    vertex of its component. Each step is written to shared storage."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    before = None
    while True:
        edges = materialise(_star(_star(edges, True), False), "components")
        # A fixed point is a forest of stars: nobody's root has a root, and each has one.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
        if now == before:
            return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
        before = now
