"""Line deduplication over overlapping windows of three lines, in DataFrame operations alone.

Every three consecutive lines of a document are hashed (two 64-bit hashes, so that unequal windows do not meet at any
scale).  A window seen more than once keeps its first occurrence, by document and then by position; every line covered by a
later occurrence goes.  Covered positions are merged per document, so overlapping occurrences remove a line once.

The windows are counted with partial aggregation, so that a window a third of all documents share is one row per task
before the shuffle; the way back is an equi-join whose large partitions adaptive execution splits.  Lines reach neither
Python nor the driver, and texts are shuffled once.

Defined cases: documents of fewer than three lines have no windows and stay whole; windows of three blank lines are no
repeats; a null text stays null with zero lines; null ids come first in the order; rows that agree in id and text are one
occurrence (all stay or lose the same lines).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, row_hash, pos, h1, h2``: one row for each run of ``window`` lines with something in it."""
    lines = F.split("text", "\n")
    parts = [F.element_at("lines", F.col("pos") + F.lit(k + 1)) for k in range(window)]
    blank = F.concat(*[F.trim(p) for p in parts]) == ""
    return (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("row_hash"), lines.alias("lines"))
        .where(F.size("lines") >= window)
        .withColumn("pos", F.explode(F.sequence(F.lit(0), F.size("lines") - window)))
        .where(~blank)
        .select("doc_id", "row_hash", "pos", F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))
    )


def repeats(windows: DataFrame) -> DataFrame:
    """The windows that are later occurrences: ``doc_id, row_hash, pos``."""
    place = F.struct("doc_id", "row_hash", "pos")
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first_place"), F.max(place).alias("last_place"))
        .where(F.col("first_place") != F.col("last_place"))
        .select("h1", "h2", "first_place")
    )
    return windows.join(first, ["h1", "h2"]).where(F.struct("doc_id", "row_hash", "pos") != F.col("first_place")).select("doc_id", "row_hash", "pos")


def _chosen(lines: Column, kept: Column) -> Column:
    """The lines at these places, joined; the text is split once for all of them, so a text of very many lines costs no more than its size."""
    chosen = F.transform(F.array(lines), lambda own: F.array_join(F.transform(kept, lambda i: F.element_at(own, i + 1)), "\n"))
    return F.element_at(chosen, 1)


def dedup_lines(docs: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_lines, n_removed, text``: each document without the lines that repeat a window seen before it.

    Columns named in ``carry`` come along unchanged, after these four.
    """
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), carried.alias("carried"))
    gone = (
        repeats(line_windows(docs, window))
        .groupBy("doc_id", "row_hash")
        .agg(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.lit(window - 1)))).alias("covered"))
        .select(F.col("doc_id").alias("gone_id"), F.col("row_hash").alias("gone_hash"), "covered")
    )
    joined = docs.withColumn("row_hash", F.xxhash64("text")).join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("row_hash") == F.col("gone_hash")), "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    return joined.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("covered")), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("covered").isNull(), F.col("text")).otherwise(_chosen(lines, kept)).alias("text"),
        *[F.col(f"carried.{c}").alias(c) for c in carry],
    )
