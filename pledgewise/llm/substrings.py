"""Substring deduplication by level-wise doubling.

To find the runs of 13 words that start in an earlier document too, runs of seven words are looked at first, and only where
those repeat are they extended to thirteen; longer windows have more levels, each at most twice the one before.  A long window can repeat only if every shorter one inside it does, so one shorter window stands for it: the one
with the least hash, which equal windows choose alike wherever they are.  Neighbouring windows mostly share it, so a level
hands on about one row for five words, and later levels see repeated text alone.  The search ends when no candidates survive
or the full length is reached.

Shorter runs are keyed by a 64-bit hash of the word sequence, which may pass a run on for nothing but never miss one; the full
windows are keyed by 96 bits, so that unequal ones do not meet at any scale.  Counting is pre-aggregated per task; the way back to the
documents is an equi-join that adaptive execution can split.  What survives a level is written to the checkpoint folder, so no level but
the last is worked out twice, and a lost executor costs one level.  The first level reads documents where they lie.  For the last
level and the removal, texts are dealt by document once, in one exchange that both use; where the documents with survivors are counted and few,
theirs alone.  Survivors that are proven few are broadcast.  Exact copies of a
text are found by digest beforehand, a digest that many share being spread by document: each of their windows starts in the least of them.

Defined cases: null texts have no words; rows with a null id are never an earlier document and lose nothing; rows that share
an id are one document, each judged on its own text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, Words, byte_table, covered, mix, slices, text_column, use_checkpoints

TABLE = byte_table(WHITESPACE, lower=False)


#: Parts in which the documents that share one text are told apart; numbers in a table that may be broadcast.
SALTS, BROADCAST = 32, 1_000_000
SECOND = np.uint64(0xD6E8FEB86659FD93)


def levels(window: int, base: int = 7) -> list[int]:
    """Lengths that double from ``base`` and end at ``window``."""
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def standing_for(words: Words, hashes: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each full window starts, and the least hash among the runs of ``length`` words inside it."""
    at, full = words.windows(hashes, window)
    if length == window:
        return at, full
    short = np.zeros(len(words), np.uint64)
    places, values = words.windows(hashes, length)
    short[places] = values
    least = short[at]
    for k in range(1, window - length + 1):
        np.minimum(least, short[at + k], out=least)
    return at, least


def _survives(batch: pa.RecordBatch, words: Words, hashes: np.ndarray, at: np.ndarray, length: int | None, window: int) -> np.ndarray:
    """Which full windows have a run of the level below that repeats (column ``kept``, hashes per document)."""
    if length is None:
        return np.ones(len(at), bool)
    _, below = standing_for(words, hashes, length, window)
    column = batch.column("kept")
    offsets = column.offsets.to_numpy()
    kept = column.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[offsets[0] : offsets[-1]]
    known = np.sort(_in_row(kept, np.repeat(np.arange(len(column)), np.diff(offsets))))
    if not len(known):
        return np.zeros(len(at), bool)
    wanted = _in_row(below, words.rows[at])
    return known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] == wanted


def _in_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A hash of a hash and its row."""
    return mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)))


def without_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pc.invert(batch.column("copy")))


def _emit(length: int, below: int | None, window: int) -> Callable:
    """The distinct hashes of a level in each document: ``h, g, doc_id``; ``g`` is a second hash of full windows, else zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(without_copies(batches)):
            words = Words(batch.column("text"), TABLE)
            hashes = words.hashes()
            at, value = standing_for(words, hashes, length, window)
            on = _survives(batch, words, hashes, at, below, window)
            second = words.windows(mix(hashes ^ SECOND), window)[1] if length == window else np.zeros(len(at), np.uint64)
            rows, value, second = words.rows[at[on]], value[on], (second[on] >> np.uint64(32)).astype(np.uint32)
            change = np.ones(len(rows), bool)
            change[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
            rows, value, second = rows[change], value[change], second[change]
            order = np.lexsort((value, rows))
            rows, value, second = rows[order], value[order], second[order]
            once = np.ones(len(rows), bool)
            once[1:] = (rows[1:] != rows[:-1]) | (value[1:] != value[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(value[once].view(np.int64)), pa.array(second[once].view(np.int32)), batch.column("doc_id").take(pa.array(rows[once]))], ["h", "g", "doc_id"])

    return run


def _remove(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            hashes = words.hashes()
            at, _ = words.windows(hashes, window)
            gone = covered(at[_survives(batch, words, hashes, at, window, window)], window, len(words))
            copy = batch.column("copy").to_numpy(zero_copy_only=False).astype(bool)
            gone |= (copy & (words.counts >= window))[words.rows]
            kept = []
            for row in range(batch.num_rows):
                own = gone[words.first[row] : words.first[row + 1]]
                kept.append(b" ".join(compress(words.word_list(row), (~own).tolist()) if own.any() else words.word_list(row)).decode())
            removed = np.bincount(words.rows[gone], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    return run


def exact_copies(docs: DataFrame) -> DataFrame:
    """``its_id, its_digest`` of the documents whose very text a smaller id has too."""
    digest = docs.where("text is not null").select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    shared = digest.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("digest", "least")
    salted = digest.withColumn("salt", F.pmod("doc_id", F.lit(SALTS))).join(shared.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["digest", "salt"])
    return salted.where("doc_id > least").select(F.col("doc_id").alias("its_id"), F.col("digest").alias("its_digest")).distinct()


def _small(table: DataFrame, numbers: int) -> DataFrame:
    return F.broadcast(table) if numbers <= BROADCAST else table


def dedup_substrings(docs: DataFrame, window: int = 13, base: int = 7) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: each document's words outside windows that start in a smaller doc_id too."""
    use_checkpoints(docs.sparkSession)
    docs = text_column(docs)
    named = docs.where("doc_id is not null")
    copies = exact_copies(named).checkpoint()
    copies = _small(copies, 5 * copies.count())
    marked = named.withColumn("digest", F.unhex(F.sha2("text", 256))).join(copies, F.expr("doc_id = its_id and digest = its_digest"), "left")
    marked = marked.select("doc_id", "text", F.col("its_id").isNotNull().alias("copy"))
    kept, below, survivors = None, None, 1
    *before, last = levels(window, base)
    for length in before:
        kept = repeated(marked if kept is None else marked.join(kept, "doc_id"), length, below, window).checkpoint()
        survivors = kept.agg(F.sum(F.size("kept"))).first()[0] or 0
        if not survivors:
            break
        kept, below = _small(kept, survivors), length
    none = F.lit(None).cast("array<long>")
    found = [docs.where("doc_id is null").withColumns({"copy": F.lit(False), "kept": none})]  # rows without an id lose none
    if survivors:
        if kept is None:
            dealt = marked.repartition("doc_id")
        else:
            keys = kept.select("doc_id")
            n = keys.count()
            if n <= BROADCAST:  # texts without survivors need not move
                found.append(marked.join(F.broadcast(keys), "doc_id", "left_anti").withColumn("kept", none))
                marked = marked.join(F.broadcast(keys), "doc_id", "left_semi")
            dealt = marked.repartition("doc_id")
        last_kept = repeated(dealt if kept is None else dealt.join(kept, "doc_id"), last, below, window)
        found.append(dealt.join(last_kept, "doc_id", "left"))
    else:  # only exact copies lose words
        found.append(marked.withColumn("kept", none))
    return reduce(DataFrame.unionByName, found).mapInArrow(_remove(window), "doc_id long, n_words long, n_removed long, text string")


def repeated(source: DataFrame, length: int, below: int | None, window: int) -> DataFrame:
    """``doc_id, kept``: hashes of a level that another document has too; of full windows, those that a smaller id has."""
    rows = source.mapInArrow(_emit(length, below, window), "h long, g int, doc_id long")
    if length < window:
        rows = rows.select("h", "doc_id")
        back = rows.join(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "h")
    else:
        back = rows.join(rows.groupBy("h", "g").agg(F.min("doc_id").alias("least")), ["h", "g"]).where("doc_id > least")
    return back.groupBy("doc_id").agg(F.collect_set("h").alias("kept"))


def digest_rows(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
