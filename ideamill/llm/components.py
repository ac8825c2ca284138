"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ideamill.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    # Decimals, as a sum of hashes may pass the range of a long.
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node of edges (a, b) other than a smallest one, with the smallest of its component.

    Rounds are written tables; their number grows with the logarithm of the longest chain. Nodes of
    many edges meet their minimum through an aggregate and a join, never in one task.
    """
    now = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while before != (state := _state(now)):
        before = state
        if not state[0]:
            break
        now = written(_small_star(written(_large_star(now), "edges")), "edges")
    return now
