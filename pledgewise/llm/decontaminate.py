"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of 13 consecutive words (a shorter item is one window).  Containing a window means
containing all of its five-word shingles, so it is enough to look up one: the prefix of length one when a window's
shingles are ordered from rare to common.  Rarity is counted over all documents first.  A document shingle that is some
window's prefix gives a candidate position, which must leave room for the whole window inside the document (length and
position bounds); candidates are then verified word for word.

The distinct windows of all items are a table.  They are collected and broadcast in blocks by hash, of about ``block_windows``
windows whatever the items' number and length.  With one block, documents are judged in one pass without shuffles; with more, each
block is a pass of its own that gives the places it hits, which are joined to the documents at the end, so no task
ever holds two blocks.  A window carries the ids of its items if they are at most ``FEW``; one that more items share carries its hash alone, and
its ids, of any number, are joined to the documents that hit it.

Defined cases: a null or wordless text has no words, no hits and no items; a null or wordless item has no windows;
repeated rows each get their own result row; items that share an id count once; ids of items are text of any kind; windows of an
item without an id hit words, but no item is named or counted for them.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, byte_table, covered, slices, use_checkpoints

#: Words are runs of digits, letters and anything outside ASCII.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
SEPARATORS = bytes(b for b in SEPARATORS if not 65 <= b <= 90)
TABLE = byte_table(SEPARATORS, lower=True)
WINDOW, SHINGLE, FEW = 13, 5, 16
#: Phrase, words, ids of its items, and its hash if they are left out.
Windows = list[tuple[bytes, int, tuple[str, ...], int | None]]
SPANS = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``phrase, n, item_id``: each distinct window (words joined by one space) with its length in words, a row for each of its items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            at, phrases, sizes = [], [], []
            for row in range(batch.num_rows):
                own = words.word_list(row)
                for i in range(max(len(own) - window + 1, 1 if own else 0)):
                    at.append(row)
                    phrases.append(b" ".join(own[i : i + window]).decode())
                    sizes.append(min(len(own), window))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(at, pa.int64())), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32())], ["item_id", "phrase", "n"])

    found = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "item_id string, phrase string, n int")
    return found.distinct()


def with_ids(windows: DataFrame, few: int = FEW) -> DataFrame:
    """``phrase, n, ids, many``: each window once; of more than ``few`` ids there are none, but the hash ``many``."""
    counted = windows.groupBy("phrase", "n").agg(F.count("item_id").alias("k"))
    listed = windows.join(counted.where(F.col("k") <= few).drop("k"), ["phrase", "n"], "left_semi").groupBy("phrase", "n").agg(F.sort_array(F.collect_set("item_id")).alias("ids"), F.lit(None).cast("long").alias("many"))
    return listed.union(counted.where(F.col("k") > few).select("phrase", "n", F.array().cast("array<string>").alias("ids"), F.xxhash64("phrase").alias("many")))


def _shingle_hashes(phrase: bytes, shingle: int) -> np.ndarray:
    words = Words(pa.array([phrase.decode()]), TABLE)
    return words.windows(words.hashes(), min(shingle, len(words)))[1]


def shingle_counts(docs: DataFrame, windows: Windows, shingle: int = SHINGLE) -> dict[int, int]:
    """How often each shingle of the windows occurs in all documents; no more rows than the windows have shingles."""
    wanted: dict[int, list[np.ndarray]] = defaultdict(list)
    for phrase, n, *_ in windows:
        wanted[min(n, shingle)].append(_shingle_hashes(phrase, shingle))
    keys = {n: np.unique(np.concatenate(h)) for n, h in wanted.items()}
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {n: np.zeros(len(k), np.int64) for n, k in sent.value.items()}
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            hashes = words.hashes()
            for n, known in sent.value.items():
                got = words.windows(hashes, n)[1]
                at = np.minimum(np.searchsorted(known, got), len(known) - 1)
                totals[n] += np.bincount(at[known[at] == got], minlength=len(known))
        for n, known in sent.value.items():
            met = totals[n] > 0
            yield pa.RecordBatch.from_arrays([pa.array(known[met].view(np.int64)), pa.array(totals[n][met])], ["h", "n"])

    rows = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).collect() if keys else []
    return {r.h & (1 << 64) - 1: r.n for r in rows}


def prefix_index(windows: Windows, rarity: dict[int, int], shingle: int = SHINGLE) -> dict[int, tuple[np.ndarray, list[list[tuple]]]]:
    """By shingle length: the sorted prefix shingles, and for each the windows it stands for with its place in them."""
    by: dict[int, dict[int, list[tuple]]] = defaultdict(lambda: defaultdict(list))
    for phrase, n, ids, many in windows:
        hashes = _shingle_hashes(phrase, shingle).tolist()
        at = min(range(len(hashes)), key=lambda i: (rarity.get(hashes[i], 0), hashes[i]))
        by[min(n, shingle)][hashes[at]].append((at, n, phrase, ids, many))
    return {n: (np.array(sorted(found), np.uint64), [found[h] for h in sorted(found)]) for n, found in by.items()}


def _found(words: Words, index: dict) -> tuple[list[list[tuple[int, int]]], list[set[str]], list[set[int]]]:
    """Of each row, where windows stand and how long they are, the ids of their items, and the hashes of those without ids."""
    n_rows = len(words.first) - 1
    spans, items, shared = [[] for _ in range(n_rows)], [set() for _ in range(n_rows)], [set() for _ in range(n_rows)]
    hashes, rows = words.hashes(), words.rows
    for n, (known, windows) in index.items():
        at, got = words.windows(hashes, n)
        place = np.minimum(np.searchsorted(known, got), len(known) - 1)
        for i in np.flatnonzero(known[place] == got):
            row = rows[at[i]]
            for offset, length, phrase, ids, many in windows[place[i]]:
                first = at[i] - offset
                if first < words.first[row] or first + length > words.first[row + 1]:
                    continue
                if b" ".join(words.data[words.starts[first] : words.ends[first + length - 1]].tobytes().split()) == phrase:
                    spans[row].append((int(first - words.first[row]), length))
                    items[row].update(ids)
                    if many is not None:
                        shared[row].add(many)
    return spans, items, shared


NAMED = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<at:int,n:int>>"


def _judged(batch: pa.RecordBatch, words: Words, spans: list, items: list, carry: list[str]) -> pa.RecordBatch:
    n_words, n_hit = words.counts.tolist(), []
    for total, own in zip(n_words, spans, strict=True):
        n_hit.append(int(covered(np.array([a for a, _ in own]), np.array([n for _, n in own]), total).sum()) if own else 0)
    columns = [
        batch.column("doc_id"),
        pa.array(n_words, pa.int64()),
        pa.array(n_hit, pa.int64()),
        pa.array([len(x) for x in items], pa.int64()),
        pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()),
        pa.array([h > 0 and 20 * h >= n for h, n in zip(n_hit, n_words, strict=True)], pa.bool_()),
        pa.array([[{"at": a, "n": n} for a, n in x] for x in spans], SPANS),
    ]
    return pa.RecordBatch.from_arrays([*columns, *[batch.column(c) for c in carry]], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", *carry])


def _match(sent, carry: list[str]) -> Callable:
    """Judges documents by the one block there is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            spans, items, _ = _found(words, sent.value)
            yield _judged(batch, words, spans, items, carry)

    return run


def _hits(sent) -> Callable:
    """What one block hits: the rows with a hit alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans, items, shared = _found(Words(batch.column("text"), TABLE), sent.value)
            hit = [i for i, x in enumerate(spans) if x]
            at = pa.array(hit, pa.int64())
            found = [pa.array([[{"at": a, "n": n} for a, n in spans[i]] for i in hit], SPANS), pa.array([sorted(items[i]) for i in hit], pa.list_(pa.string())), pa.array([sorted(shared[i]) for i in hit], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("row_hash").take(at), *found], ["doc_id", "row_hash", "spans", "items", "shared"])

    return run


def _merged(carry: list[str]) -> Callable:
    """Judges documents by the hits of all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans = [[(s["at"], s["n"]) for s in x or []] for x in batch.column("spans").to_pylist()]
            items = [set(x or []) for x in batch.column("items").to_pylist()]
            yield _judged(batch, Words(batch.column("text"), TABLE), spans, items, carry)

    return run


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = 100_000, few: int = FEW, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: how many of its words lie in windows of which items, where, and whether that contaminates it.

    ``few`` ids at most travel with a window.  With ``carry``, the text and those columns of the row follow.
    """
    use_checkpoints(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    kept = ["text", *carry] if carry else []
    schema = ", ".join([NAMED, *["text string" if c == "text" else f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept]])
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    by_item = item_windows(items, window).checkpoint()
    windows = with_ids(by_item, few).checkpoint()
    blocks = max(1, -(-windows.count() // block_windows))

    def index(block: int) -> dict:
        rows = windows.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block).collect()
        own = [(r.phrase.encode(), r.n, tuple(r.ids), r.many) for r in rows]
        return prefix_index(own, shingle_counts(docs, own, shingle), shingle)

    named = windows.where("many is not null")
    if blocks == 1 and named.isEmpty():
        return docs.mapInArrow(_match(context.broadcast(index(0)), kept), schema)
    keyed = docs.withColumn("row_hash", F.xxhash64(F.lit("text"), F.coalesce("text", F.lit(""))))
    spans = "doc_id long, row_hash long, spans array<struct<at:int,n:int>>, items array<string>, shared array<long>"
    found = reduce(DataFrame.union, [keyed.select("doc_id", "text", "row_hash").mapInArrow(_hits(context.broadcast(index(b))), spans).checkpoint() for b in range(blocks)])
    ids = by_item.where("item_id is not null").join(named.select("phrase", "n", "many"), ["phrase", "n"]).select("many", "item_id")
    more = found.select("doc_id", "row_hash", F.explode("shared").alias("many")).distinct().join(ids, "many").groupBy("doc_id", "row_hash").agg(F.collect_set("item_id").alias("items"))
    more = more.select("doc_id", "row_hash", F.array().cast("array<struct<at:int,n:int>>").alias("spans"), "items")
    both = found.drop("shared").union(more)
    hits = both.groupBy("doc_id", "row_hash").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    hits = hits.selectExpr("doc_id as its_id", "row_hash as its_hash", "spans", "items")
    held = keyed.join(hits, F.expr("row_hash = its_hash and doc_id <=> its_id"), "left")
    return held.select("doc_id", "text", *carry, "spans", "items").mapInArrow(_merged(kept), schema)
