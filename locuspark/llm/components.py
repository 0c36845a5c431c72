"""Connected components by alternating star contractions, as Spark joins.

Each round links every node's larger neighbours to its smallest neighbour
(large star) and then its smaller neighbours to the smallest (small star). The
edges end as one star for each component. Rounds grow with the logarithm of
the longest path. The edges of a round are written to the shared folder; a node with a
large share of the edges is looked up by broadcast, so no task holds all its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, lookup, materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    hung = lookup(both, least, ["u"], "n")
    if large:
        out = hung.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        out = hung.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a < b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: two columns of one ordered type. Returns (node, root) for each node but the roots; root is the smallest node."""
    a, b = edges.columns
    now = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    now, print_before = materialise(now, "links"), None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == print_before or not mark["n"]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        print_before = mark
        half = materialise(_star(now, True), "links")
        discard(now)
        now = materialise(_star(half, False), "links")
        discard(half)
