"""SimHash near-duplicates found through a segment-popcount embedding.

A text's fingerprint has the bits set in over half of the 64-bit hashes of its word shingles.  A fingerprint is embedded as
the bit counts of its sixteen four-bit segments: flipping one bit moves one coordinate by one, so Manhattan distance
between embeddings never exceeds Hamming distance.  Two fingerprints within two bits have embeddings at most two apart,
hence a grid point at most one from each: every fingerprint is entered at its own point and at the points one step away (33 at
most), and those that meet at a point are candidates, verified exactly by the bits that differ.

Equal fingerprints are one row before any join.  A point with at most ``point_limit`` fingerprints compares them within the
row; a fuller point is split exactly by the fingerprints one bit away that lie at this point (two fingerprints within two
bits share such a midpoint, and all who share one are within two bits), and each part is linked to its least member.  So
no key is ever paired with itself without bound and no link is lost.

Defined cases: a null or wordless text has fingerprint zero, linked like any other; fewer words than a shingle make one
shingle; rows with a null id get a component when another row of theirs has an id, else null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, Words, byte_table, slices, text_column, use_checkpoints
from .components import components

TABLE = byte_table(WHITESPACE, lower=True)
SEGMENTS, SEGMENT_BITS = 16, 4


def fingerprint(words: list[bytes], shingle: int) -> int:
    """The bits set in over half of the hashes of all shingles, repeats included."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(len(words) - shingle + 1, 1)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(text, 42)
    stops = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([digest(text[a:b], 42) for a, b in zip(starts[:n].tolist(), stops, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp``: one row for each document, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            found = np.array([fingerprint(words.word_list(r), shingle) for r in range(batch.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return text_column(docs).mapInArrow(run, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """Bit counts of the sixteen segments, four bits each, in one long."""
    ones = [F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(0x1111111111111111)) for b in range(SEGMENT_BITS)]
    return ones[0] + ones[1] + ones[2] + ones[3]


def _segment(point: Column, k: int) -> Column:
    return F.shiftrightunsigned(point, SEGMENT_BITS * k).bitwiseAND(F.lit(15))


def _step(k: int) -> Column:
    return F.shiftleft(F.lit(1).cast("long"), SEGMENT_BITS * k)


def points_near(point: Column) -> Column:
    """The point and all grid points one step from it, as an array."""
    up = [F.when(_segment(point, k) < SEGMENT_BITS, point.bitwiseXOR(_segment(point, k) * _step(k)).bitwiseOR((_segment(point, k) + 1) * _step(k))) for k in range(SEGMENTS)]
    down = [F.when(_segment(point, k) > 0, point.bitwiseXOR(_segment(point, k) * _step(k)).bitwiseOR((_segment(point, k) - 1) * _step(k))) for k in range(SEGMENTS)]
    return F.array_compact(F.array(point, *up, *down))


def _pairs(members: Column, bits: int) -> Column:
    """The pairs of a sorted array of fingerprints that differ in at most ``bits`` bits."""
    return F.flatten(
        F.transform(
            members,
            lambda x, i: F.transform(
                F.filter(F.slice(members, i + 2, F.size(members)), lambda y: F.bit_count(x.bitwiseXOR(y)) <= bits),
                lambda y: F.struct(x.alias("a"), y.alias("b")),
            ),
        )
    )


def links(fps: DataFrame, point_limit: int = 48) -> DataFrame:
    """Edges ``a, b`` between different fingerprints that connect all that lie within two bits of each other."""
    bits = 2  # what one step on either side can reach
    use_checkpoints(fps.sparkSession)
    # dealt anew, as a few small partitions would become 33 times as many rows each; kept, as what follows reads it three times
    dealt = fps.select("fp").distinct().repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    entered = dealt.select("fp", F.explode(points_near(embedding(F.col("fp")))).alias("point")).checkpoint()
    held = entered.groupBy("point").agg(F.count("*").alias("n")).where("n > 1")
    met = entered.join(held, "point")
    paired = met.where(F.col("n") <= point_limit).groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("members"))
    paired = paired.select(F.explode(_pairs(F.col("members"), bits)).alias("e")).select("e.a", "e.b")
    flips = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))))
    middles = met.where(F.col("n") > point_limit).select("fp", "point", F.explode(flips).alias("middle")).where(embedding(F.col("middle")) == F.col("point"))
    hub = middles.groupBy("middle").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1").select("middle", "hub")
    split = middles.join(hub, "middle").select(F.col("hub").alias("a"), F.col("fp").alias("b")).where("a <> b")
    return paired.union(split).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, point_limit: int = 48) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the least doc_id reachable over links of at most two differing bits."""
    use_checkpoints(docs.sparkSession)
    fps = fingerprints(docs, shingle).checkpoint()
    root = components(links(fps, point_limit))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(heads, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
