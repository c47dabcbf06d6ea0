"""Connected components of an edge table by alternating large and small stars.

Each step is one aggregation (partial minima first) and one join, so a node with very
many neighbours is never gathered in one place. Steps repeat until the edges form
stars, which one aggregation tells; the number of steps follows the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutpoint.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to its least neighbour (itself included)."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
            .union(edges.select("v", F.lit(0), F.lit(1))))
    other = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return other.where("down > 1 OR (down > 0 AND up > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``u, v`` (longs): the label is the
    least node of its component."""
    now = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _are_stars(now):
        # Each half step is stored: the next one reads it more than once.
        large = store(_large_star(now).distinct(), "edges")
        now = store(_small_star(large).distinct(), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
