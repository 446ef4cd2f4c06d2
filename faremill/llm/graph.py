"""Connected components by alternating large-star and small-star steps.

Every step is a group-by with map-side minimum and a join back, so the centre of a star with a third
of all edges is no single task's group: Spark splits skewed joins. Edges are written to the shared
folder after each round, which cuts the lineage; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Re-hang the neighbours of each node on the least of them (edges are (a, b) with a < b)."""
    away = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    sides = away.union(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) if large else away
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    hung = sides.join(least, "u")
    if large:
        moved = hung.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = hung.select(F.col("m").alias("a"), F.col("v").alias("b")).union(
            hung.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return moved.where(F.col("a") < F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node with an edge to another; the label is the component's least node.

    Nulls and loops link nothing; no edges give no rows.
    """
    left, right = F.col(a), F.col(b)
    now = edges.where(left != right).select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    now = stored(now.distinct(), "edges")
    seen = None
    while True:
        print_of = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if tuple(print_of) == seen or print_of.n == 0:
            break
        seen = tuple(print_of)
        now = stored(_stars(_stars(now, large=True), large=False), "edges")
    leaves = now.select(F.col("b").alias("node"), F.col("a").alias("label"))
    return leaves.union(now.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
