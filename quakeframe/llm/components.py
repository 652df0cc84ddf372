"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edges, written to the
shared folder, so lineage stays one round long; the number of rounds grows with
the logarithm of the longest path. Nothing but whether to go on reaches the
driver: the edges are done when they are stars, that is, when every node has one
edge down and no node that others point to has any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import materialize
from quakeframe.session import release


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _are_stars(e: DataFrame) -> bool:
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    per_node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_node.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) undirected edges of longs -> (node, root): every node with an edge
    to another one and the smallest node of its component; roots are left out."""
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _are_stars(e):
        release(e.sparkSession)  # a round is many exchanges
        e = materialize(_small_star(_large_star(e)), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
