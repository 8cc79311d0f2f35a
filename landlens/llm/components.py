"""Connected components of a graph of bigint nodes, by alternating large and small stars.

Every round replaces edges by edges to smaller nodes until all edges of a component
point to its smallest node.  A node with very many edges is joined, never gathered.
Each round's edges are written by checkpoint(), which cuts the lineage and survives
lost executors; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import checkpoint_dir


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of every node that has an edge but is not the root; ``edges``: u, v."""
    checkpoint_dir(edges.sparkSession)
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct().checkpoint()
    seen = None
    while True:
        now = _small(_large(now)).checkpoint()
        state = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
