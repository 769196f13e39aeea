"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.llm.shared import releasing, stored


def _directed(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link upwards at most, and none has one upwards and others downwards."""
    with releasing(edges.sparkSession):
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node in the links ``a``, ``b``; roots are not listed.

    Large star: every larger neighbour of a node is linked to the smallest neighbour.  Small star: every smaller neighbour is.  Both
    reduce by minima, which are combined before the shuffle, and hand them back by a join on the node, so a hub is no large group for any
    task.  The loop ends when the links are stars; each round is written to the shared folder.
    """
    edges = stored(_directed(links), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stored(_directed(small.select("e.a", "e.b")), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
