"""SimHash near-deduplication at a stated similarity: texts whose sets of five-word shingles are at least 0.8 alike are linked.

Texts with equal sets are one class.  Each class has the SimHash fingerprint of its set; ``simhash.links`` finds fingerprints
within two bits through the segment-popcount grid, and each class is held against the least one of the least fingerprint linked to its own.
Sets are compared whole, so no wrong link is made, and most copies with small changes are joined here at one comparison each.

Fingerprints alone would miss links: at a similarity of 0.8 about ten of 64 bits differ, and within ten bits the popcount
bound passes nearly every pair of unrelated texts.  So what is left is completed by a prefix-filtered join.  In one order of all
shingles, two sets this alike share a shingle among the first n - ceil(0.8 n) + 1 of each; a class is entered under these alone,
and classes of different groups that meet under a shingle, where sizes and places leave room for 0.8, are candidates.  Each is first held against one
under the shingle, that which shares most; then only those outside the least one's group are paired with the others.  Any order gives the same
links.  Shingles that are frequent in all texts come last, so passages shared by many texts are
seldom entered.  Where that pairing would still be large for what stands under a shingle (``CROWD``), classes meet under it and a second one
instead: two sets this alike share at least two shingles among one more of their first, and the first shared comes before the second.

Before texts are fetched, candidates are held against a wider embedding of the same kind: how many of a set's hashes fall into each of
``CELLS`` cells.  The Manhattan distance of two such rows of counts never exceeds the number of shingles that only one set has.

What is compared are 64-bit hashes of shingles.  Keys are broadcast where a count shows that they are at most ``BROADCAST`` rows, and
joined by a shuffle otherwise.

Defined cases: fewer words than a shingle make one shingle; null and wordless texts are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import WHITESPACE, Words, byte_table, give_back, range_hash, slices, use_checkpoints, written
from .components import stars

TABLE = byte_table(WHITESPACE, lower=True)
SHINGLE, CELLS, PLACE_BITS = 5, 256, 21
BROADCAST, CROWD, TASK_ROWS = 2_000_000, 64, 100_000
SAME_ROW = "h = its_h and doc_id <=> its_id"


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's distinct shingles begin (one more at the end), and their hashes, ascending in each row."""
    words = Words(texts, TABLE)
    hashes, counts = words.hashes(), words.counts
    at, got = words.windows(hashes, SHINGLE)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    row = np.concatenate([words.rows[at], short])
    got = np.concatenate([got, range_hash(hashes, words.first[short], words.first[short + 1])])
    order = np.lexsort((got, row))
    row, got = row[order], got[order]
    new = np.ones(len(got), bool)
    new[1:] = (got[1:] != got[:-1]) | (row[1:] != row[:-1])
    return np.searchsorted(row[new], np.arange(len(texts) + 1)), got[new]


def set_fingerprints(first: np.ndarray, got: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """The bits set in over half of each row's hashes; zero for an empty row."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    ones = np.zeros((len(n), 64), np.int64)
    for at in range(0, len(got), step):
        bits = np.unpackbits(got[at : at + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = row[at : at + step]
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        ones[own[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def cell_counts(first: np.ndarray, got: np.ndarray) -> np.ndarray:
    """How many hashes of each row fall into each cell, at most 65,535."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    counts = np.bincount(row * CELLS + (got >> np.uint64(56)).astype(np.int64), minlength=(len(first) - 1) * CELLS)
    return np.minimum(counts, 65_535).astype(np.uint16).reshape(-1, CELLS)


def _total(*keys: str):
    """The sums of counts that stand in a row under equal ``keys``; they stop at the largest 32-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, np.zeros(1 << PLACE_BITS - 6, np.int64)

        def done() -> pa.RecordBatch:
            total = np.minimum(held, np.iinfo(np.int32).max).astype(np.int32)
            held[:] = 0
            return pa.RecordBatch.from_arrays([pa.array([now["part"]], pa.int32()), pa.array([now["block"]], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "block", "counts"])

        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and any(row[k] != now[k] for k in keys):
                    yield done()
                now = row
                held += np.frombuffer(row["counts"], np.int32)
        if now is not None:
            yield done()

    return run


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places that frequent shingles share, ascending, and how often texts have shingles there; they shape the order and nothing else.

    The shingles of all texts are counted by the first ``PLACE_BITS`` bits of their hashes, so that a task counts in bounded memory; counts are
    added up by blocks of places, of 64 tasks first.  A place is frequent that has six standard deviations more than evenly spread shingles would give it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << PLACE_BITS, np.int32)
        for batch in slices(batches):
            place, n = np.unique(shingle_sets(batch.column("text"))[1] >> np.uint64(64 - PLACE_BITS), return_counts=True)
            counts[place.astype(np.int64)] += n.astype(np.int32)
        part = TaskContext.get().partitionId() // 64
        for block, piece in enumerate(counts.reshape(64, -1)):
            if piece.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([piece.tobytes()], pa.binary())], ["part", "block", "counts"])

    schema = "part int, block int, counts binary"
    pieces = docs.select("text").mapInArrow(run, schema)
    for keys in (["part", "block"], ["block"]):
        pieces = pieces.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_total(*keys), schema)
    total, found = np.zeros((64, 1 << PLACE_BITS - 6), np.int32), pieces.toArrow()
    for block, counts in zip(found["block"].to_pylist(), found["counts"], strict=True):
        total[block] = np.frombuffer(counts.as_buffer(), np.int32)
    del found
    give_back()
    total, mean = total.ravel(), total.mean()
    places = np.flatnonzero(total >= mean + 6 * np.sqrt(mean) + 3)
    return places.astype(np.uint64), total[places].astype(np.int64)


def entries(docs: DataFrame) -> DataFrame:
    """``doc_id, h, class, n, fp, prefix, cells``: a row for each text; the class stands for its set, ``h`` for the text itself.

    ``prefix`` has one shingle more than must be entered, where there is one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = sent.value
        for batch in slices(batches):
            first, got = shingle_sets(batch.column("text"))
            n = np.diff(first)
            row = np.repeat(np.arange(len(n)), n)
            classes = np.array([xxhash.xxh3_64_intdigest(got[a:b].tobytes()) for a, b in zip(first[:-1], first[1:], strict=True)], np.uint64)
            prints, cells = set_fingerprints(first, got), [bytes(c) for c in cell_counts(first, got)]
            rank = np.zeros(len(got), np.int64)
            if len(known):
                own = got >> np.uint64(64 - PLACE_BITS)
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                rank = np.where(known[place] == own, often[place], 0)
            got = got[np.lexsort((got, rank, row))]
            size = np.where(n > 0, n - (4 * n + 4) // 5 + 1, 0)
            size = np.minimum(size + 1, n)
            prefix = got[np.arange(len(got)) - first[row] < size[row]]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(prefix.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(classes.view(np.int64)), pa.array(n, pa.int64()), pa.array(prints.view(np.int64)), lists, pa.array(cells, pa.binary())],
                ["doc_id", "h", "class", "n", "fp", "prefix", "cells"],
            )

    return docs.mapInArrow(run, "doc_id long, h long, class long, n long, fp long, prefix array<long>, cells binary")


def sized(keys: DataFrame) -> DataFrame:
    """Written once, and marked for broadcast if it is small; ``keys`` holds a few numbers a row."""
    keys, seen = written(keys, F.count(F.lit(1)).alias("rows"))
    return _marked(keys, seen.rows)


def _marked(keys: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(keys) if rows <= BROADCAST else keys


def _room(n: str, i: str, m: str, j: str) -> Column:
    """Whether sets of ``n`` and ``m`` shingles may be 0.8 alike when the first that they share has places ``i`` and ``j``."""
    n, i, m, j = F.col(n), F.col(i), F.col(m), F.col(j)
    return (5 * F.least(n, m) >= 4 * F.greatest(n, m)) & (9 * (1 + F.least(n - i - 1, m - j - 1)) >= 4 * (n + m))


def _near_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose counts by cell do not rule out a similarity of 0.8: at most a ninth of both sets may be in one alone."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, CELLS).astype(np.int64) for c in ("x", "y"))
        far = np.abs(x - y).sum(axis=1)
        # a full cell may hide more: it still bounds from below
        sizes = batch.column("n").to_numpy() + batch.column("m").to_numpy()
        yield batch.select(["a", "b", "at_a", "at_b"]).filter(pa.array(9 * far <= sizes))


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices([whole], "text", "other"):
            (f, x), (g, y) = shingle_sets(batch.column("text")), shingle_sets(batch.column("other"))
            both = np.array([len(np.intersect1d(x[f[r] : f[r + 1]], y[g[r] : g[r + 1]], assume_unique=True)) for r in range(batch.num_rows)])
            alike = 5 * both >= 4 * (np.diff(f) + np.diff(g) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(alike))


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> tuple[DataFrame, int]:
    """The pairs of classes ``a, b`` whose whole sets are at least 0.8 alike, and how many; ``b`` should be the one in fewer pairs.

    Each pair takes along where the texts of its classes are, so that they are fetched without meeting the classes again.
    """
    x = classes.select(F.col("c").alias("a"), F.col("cells").alias("x"), "n", F.struct("doc_id", "h").alias("at_a"))
    y = classes.select(F.col("c").alias("b"), F.col("cells").alias("y"), F.col("n").alias("m"), F.struct("doc_id", "h").alias("at_b"))
    held = pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y", "n", "m", "at_a", "at_b")
    place = "struct<doc_id:long,h:long>"
    pairs, seen = written(held.mapInArrow(_near_enough, f"a long, b long, at_a {place}, at_b {place}"), F.count(F.lit(1)).alias("rows"))
    if not seen.rows:
        return pairs.select("a", "b"), 0
    pairs = pairs.coalesce(1 + seen.rows // TASK_ROWS)
    ends = F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("at_a").alias("at")), F.struct(F.col("b").alias("c"), F.col("at_b").alias("at")))).alias("end")
    keys = sized(pairs.select(ends).select("end.c", F.col("end.at.doc_id").alias("its_id"), F.col("end.at.h").alias("its_h")).distinct())
    texts = docs.select("doc_id", "h", "text").join(keys, F.expr(SAME_ROW)).select("c", "text").dropDuplicates(["c"])
    held = pairs.select("a", "b").join(texts.select(F.col("c").alias("b"), F.col("text").alias("other")), "b").join(texts.withColumnRenamed("c", "a"), "a")
    alike, seen = written(held.select("a", "b", "text", "other").mapInArrow(_alike, "a long, b long"), F.count(F.lit(1)).alias("rows"))
    return alike.coalesce(1 + seen.rows // TASK_ROWS), seen.rows


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect all classes ``c`` whose sets are at least 0.8 alike, each verified."""
    linked = simhash.links(classes.select("fp")).groupBy(F.greatest("a", "b").alias("fp")).agg(F.min(F.least("a", "b")).alias("its_fp"))
    narrow = classes.select("c", "fp")
    heads = narrow.groupBy(F.col("fp").alias("its_fp")).agg(F.min("c").alias("a"))
    placed = narrow.join(linked, "fp", "left").select(F.col("c").alias("b"), F.coalesce("its_fp", "fp").alias("its_fp"))
    alike, found = verified(placed.join(heads, "its_fp").where("a <> b").select("a", "b"), docs, classes)

    # classes of one root are linked; a root may have a root of its own
    root = _marked(alike.select(F.col("b").alias("c"), F.col("a").alias("root")), found)
    entered = classes.select("c", "n", "prefix").join(root, "c", "left").withColumn("root", F.coalesce("root", "c"))
    entered = entered.select("c", "n", "root", F.posexplode("prefix").alias("at", "k")).where("at < n - (4 * n + 4) div 5 + 1")
    shared = entered.groupBy("k").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).where("r1 <> r2").select("k")
    met = entered.join(sized(shared), "k").select("k", "c", "n", "at", "root").checkpoint()
    # the class with most of its shingles shared is likeliest the one that others were copied from
    held = met.groupBy("c").agg(F.count("*").alias("shares"))
    hub = met.join(sized(held), "c").groupBy("k").agg(F.min(F.struct((-F.col("shares")).alias("order"), "c", "n", "at", "root")).alias("hub"))
    under = met.join(hub.select("k", "hub.c", "hub.n", "hub.at", "hub.root").toDF("k", "hub", "m", "j", "hub_root"), "k")
    near, _ = verified(under.where("root <> hub_root").where(_room("n", "at", "m", "j")).select(F.col("hub").alias("a"), F.col("c").alias("b")).distinct(), docs, classes)

    # what was found so far goes on as stars
    found, rows = stars(alike.union(near))
    placed = under.select("k", "c", "n", "at", "hub")
    for node, name in (("c", "root"), ("hub", "main")):
        placed = placed.join(_marked(found.toDF(node, name), rows), node, "left").withColumn(name, F.coalesce(name, node))
    placed = placed.select("k", "c", "n", "at", "root", "main", (F.col("c") == F.col("hub")).alias("is_hub")).checkpoint()
    return found.union(verified(_across(placed, classes).distinct(), docs, classes)[0])


def _across(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of different groups under a shingle, of which at least one is outside the main group: by a second shingle where there are many."""
    apart, others = F.count_if(F.expr("root <> main")), F.count_if(~F.col("is_hub"))
    crowded = sized(placed.groupBy("k").agg(apart.alias("x"), others.alias("y")).where(F.col("x") * F.col("y") > CROWD * (F.col("x") + F.col("y"))).select("k"))

    def paired(rows: DataFrame, keys: list[str]) -> DataFrame:
        left = rows.where("root <> main").select(*keys, F.col("c").alias("b"), F.col("n").alias("m"), F.col("at").alias("j"), F.col("root").alias("b_root"))
        right = rows.where("not is_hub").select(*keys, F.col("c").alias("a"), "n", "at", "root", "main")
        return left.join(right, keys).where("b_root <> root and (root = main or b < a)").where(_room("n", "at", "m", "j")).select("a", "b")

    second = placed.join(crowded, "k", "left_semi").join(classes.select("c", "prefix"), "c").select("*", F.posexplode("prefix").alias("at2", "k2")).where("at2 > at").drop("prefix", "at2")
    return paired(placed.join(crowded, "k", "left_anti"), ["k"]).union(paired(second, ["k", "k2"]))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component of alike texts, the least by (id, hash of the text) with null ids last, and all its columns.

    The caller's columns may have any names: they travel in one column of their own until the end.
    """
    use_checkpoints(docs.sparkSession)
    columns = docs.columns
    whole = docs.select("doc_id", "text", F.struct(*columns).alias("whole_row"), F.xxhash64(F.lit("text"), F.coalesce("text", F.lit(""))).alias("h"))
    docs = whole.select("doc_id", "h", "text")
    # numbered once written, so that the numbers stay
    rows = entries(docs).withColumn("c", F.monotonically_increasing_id()).checkpoint()
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "c")
    copies = rows.groupBy("class").agg(F.min(first).alias("one"), F.count("*").alias("k")).where("k > 1").select("class", F.col("one.c").alias("one"))
    copies = sized(copies)
    named = rows.select("class", "c", "doc_id", "h").join(copies, "class", "left").select("c", "doc_id", "h", F.coalesce("one", "c").alias("one"))
    classes = rows.join(copies, "class", "left").where("one is null or one = c").drop("one")
    root = _marked(*stars(links(docs, classes)))
    placed = named.join(root.toDF("one", "root"), "one", "left").withColumn("root", F.coalesce("root", "one"))
    same = placed.groupBy("root", "doc_id", "h").agg(F.count("*").alias("k"))
    kept = same.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("one"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    judged = same.join(sized(kept), "root", "left").withColumn("stays", F.col("one").isNull() | (F.col("one.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("one.h") == F.col("h"))))
    judged = sized(judged.where("not stays or k > 1").selectExpr("doc_id as its_id", "h as its_h", "stays"))
    repeated = whole.join(judged.where("stays"), F.expr(SAME_ROW), "left_semi").dropDuplicates(["doc_id", "h"])
    return whole.join(judged, F.expr(SAME_ROW), "left_anti").union(repeated).select("whole_row.*")
