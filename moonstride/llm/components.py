"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moonstride.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``edges`` (``a``, ``b``: long).

    Each round hangs the neighbours of a node on the smallest of them, first the larger ones, then
    the smaller ones, and is written out. Smallest neighbours are found by an aggregate and an
    equality join, so a node with very many edges is pre-aggregated and its rows can be split.
    Loops and repeated edges do no harm; no edges give no rows.
    """
    stars = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = stars.union(stars.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("_a"), F.least("least", "_a").alias("least"))
        large = both.join(least, F.col("a") == F.col("_a")).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large-stars")
        low = large.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "_a")
        hung = large.join(low, F.col("a") == F.col("_a")).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = stage(hung.union(low.select("_a", "least")).distinct(), "small-stars")
    roots = stars.select(F.col("b").alias("node")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node")))
