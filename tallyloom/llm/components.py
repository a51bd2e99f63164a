"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import checkpointed, meet, written


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for each node of edges (a, b) that isn't its own root.

    Each star joins edges to the smallest neighbour of a node, one row out for a row in, never nodes of a group to each other, and is written
    to the checkpoint folder. A node that many edges share is split among tasks. Rounds grow with the logarithm of the longest path; a sum by
    node tells whether another is needed. Null ends and loops are left out.
    """
    now = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _settled(now):
        large = checkpointed(_large_star(now))  # the small star asks for it twice
        now = checkpointed(_small_star(large))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _settled(edges: DataFrame) -> bool:
    """Whether each node that an edge leads down from has that edge alone, so that all edges lead to a smallest node."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.sum("up").alias("up")).filter("down > 0 AND down + up > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "stars")
    return meet(both.filter("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "stars")
    linked = meet(down, least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
