"""Connected components of a table of links, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.storage import drop, stored


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``links`` (columns ``a`` and ``b``).

    A large-star step links the larger neighbours of each node to its smallest neighbour, a
    small-star step the smaller ones.  The number of links never grows, and a node with very
    many is only ever reduced to its smallest neighbour, never gathered.  Each round is written to
    the shared folder.  Links of a node to itself, repeated ones and nulls change nothing.
    """
    whole = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(spark, whole.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(edges)
    while before != (0, None):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        made = stored(spark, small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(made)
        drop(spark, edges)
        edges = made
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple[int, object]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
