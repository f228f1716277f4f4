"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import table


def components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of bigints -> ``(node, root)``, root being the smallest node; roots themselves are left out.

    Every step is one partial minimum per node and one join on it, both of which spread a node with many
    neighbours. Each round is written to the shared folder, which cuts the lineage. Loops, repeated edges and
    either direction are allowed; no edges give no rows.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = table(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        # Large star: the larger neighbours of a node move to the smallest in its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the smaller neighbours of a node, and the node, move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = table(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
