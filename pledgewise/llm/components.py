"""Connected components of an edge table by alternating star contractions, all in DataFrame joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import use_checkpoints, written


BROADCAST, TASK_ROWS = 500_000, 100_000


def _marked(edges: DataFrame) -> tuple[DataFrame, Row]:
    """The edges, checkpointed, and a mark that is equal for equal sets of edges: how many there are, and hashes of them all."""
    both_ways = F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", F.lit(1), "a")).alias("y")
    edges, mark = written(edges, F.count(F.lit(1)).alias("rows"), *both_ways)
    return edges.coalesce(1 + mark.rows // TASK_ROWS), mark  # else few edges would be read again and again in many small tasks


def stars(edges: DataFrame) -> tuple[DataFrame, int]:
    """Each node ``a`` of ``edges(a, b)`` that reaches a smaller one, with the least that it reaches as ``b``; and how many there are.

    Large-star: each node links its larger neighbours to the least of its neighbourhood.  Small-star: each node links its
    smaller neighbours and itself to the least of them.  Alternating the two ends in stars.  Every step keeps the number
    of edges at or below what it was, gathers only minima per node, and is checkpointed to shared storage, so that a lost
    executor costs one step.  Null nodes and loops are ignored.  Whether a step changed anything is seen as it is written; a
    task that ran twice may cost one more step.  Minima are broadcast where there are at most ``BROADCAST`` edges, and joined by a
    shuffle otherwise.
    """
    use_checkpoints(edges.sparkSession)
    edges, before = _marked(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while before.rows:
        sent = F.broadcast if before.rows <= BROADCAST else lambda minima: minima
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(sent(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")  # at most a row for each edge
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        root = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(sent(root), "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges, after = _marked(small.where("a <> b").distinct())
        if after == before:
            break
        before = after
    return edges, before.rows


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the least node that it reaches."""
    edges, _ = stars(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())
