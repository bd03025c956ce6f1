"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_step, release, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b")))


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has two larger-to-smaller edges, or edges both ways: then it is no star yet."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    ways = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not ways.filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``(a, b)``; the label is the smallest node.

    Links of a node with itself are ignored.  Each round is stored, so a lost executor costs one
    round; the loop ends when every component is a star around its smallest node.
    """
    edges, before = links.filter("a <> b").select("a", "b"), None
    while True:
        done = stored(_small_star(_large_star(edges)).distinct(), "components")
        if before is not None:
            drop_step(before)
        release(links.sparkSession)
        if not _unfinished(done):
            return done.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                done.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        edges = before = done
