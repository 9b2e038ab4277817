"""Ranked lexical search: impact-sorted lists read in sequence, without random access (NRA).

Two passes lead to a search.  ``index`` reads whole texts once and writes, for each document that holds a term of some item, its length
and its counts of these terms.  The corpus numbers (documents, terms, documents of a term) are then added up from all rows.

The search deals with documents shard by shard: a task gathers indexed documents until a shard holds about ``SHARD`` entries, works out the
impact of each (term, document), and sorts every term's list by falling impact.  For each item the lists of its terms are read in
step, deeper each time.  A document's lower bound is what has been read of it, its upper bound adds the frontier of every list in which it
has not been met.  A document that no list has shown yet can have the sum of the frontiers at most.  Reading goes on until no
unseen document and none outside the k best can reach the k-th best lower bound, ties included, and until every one that can has
lower equal to upper.  The k best of the task's earlier shards go on raising that bound, so most lists are left early.  A task gives
its k best of each item; these are ranked over all tasks.

Items are dealt into blocks of about ``block_pairs`` (item, term) pairs by hash, collected and broadcast block by block, so what a task holds of them
is bounded; documents are read once for each block.  Terms are met by 64-bit hashes.

Defined cases: a null or wordless text has no terms, and is not counted; every row of an id is a document of its own, and
documents without an id come last among equal scores; items without terms give no rows; rows that agree in id and text are one item, and
rows that share an id alone have a list each; a repeated term counts once for an item; texts and items of any length are
whole; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, give_back, slices, text_column, use_checkpoints
from .decontaminate import TABLE

#: Entries of a shard; entries read of a list at first, doubled each time; (item, term) pairs of a block.
SHARD, DEPTH, BLOCK_PAIRS = 1_000_000, 64, 500_000
INDEXED = "doc_id long, n long, terms array<long>, tf array<long>"


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values, kind))


def _own_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    for batch in slices(batches):
        words = Words(batch.column("text"), TABLE)
        pairs = np.unique(np.stack([words.rows.astype(np.uint64), words.hashes()]), axis=1) if len(words) else np.zeros((2, 0), np.uint64)
        own = batch.column("item").take(pa.array(pairs[0].astype(np.int64)))
        yield pa.RecordBatch.from_arrays([own, pa.array(pairs[1].view(np.int64))], ["item", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term``: the hashes of each item's distinct terms, ``item`` being a number of the row's content."""
    rows = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    numbered = rows.withColumn("item", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("item_id").isNull(), "text"))
    found = numbered.select("item", "text").mapInArrow(_own_terms, "item long, term long")
    return found.join(numbered.selectExpr("item as its_item", "item_id"), F.expr("item = its_item")).select("item", "item_id", "term")


def _index(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches):
            words = Words(batch.column("text"), TABLE)
            hashes, rows = words.hashes().view(np.int64), words.rows
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            met = known[at] == hashes if len(known) else np.zeros(len(words), bool)
            key, tf = np.unique(rows[met] * max(len(known), 1) + at[met], return_counts=True)
            row = key // max(len(known), 1)
            sizes = np.bincount(row, minlength=batch.num_rows)
            kept = np.flatnonzero(words.counts > 0)
            columns = [batch.column("doc_id"), pa.array(words.counts, pa.int64()), _lists(known[key % max(len(known), 1)], sizes, pa.int64()), _lists(tf, sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(kept)) for c in columns], ["doc_id", "n", "terms", "tf"])

    return run


def _totals(sent) -> Callable:
    """A task's documents, terms, and documents of each term; one row a number, the first two without a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        docs, length, df = 0, 0, np.zeros(len(known), np.int64)
        for batch in batches:
            docs += batch.num_rows
            length += pc.sum(batch.column("n")).as_py() or 0
            df += np.bincount(np.searchsorted(known, batch.column("terms").flatten().to_numpy(zero_copy_only=False)), minlength=len(known))
        met = np.flatnonzero(df)
        kinds, terms, counts = ([0, 1] + [2] * len(met)), [None, None, *known[met].tolist()], [docs, length, *df[met].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(terms, pa.int64()), pa.array(counts, pa.int64())], ["kind", "term", "n"])

    return run


class Shard:
    """Indexed documents with the impact-sorted lists of their terms."""

    def __init__(self, doc_ids: list, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int):
        self.doc_ids = doc_ids
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, terms: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and final scores among which are all that belong to the k best; ``reach``: what k documents elsewhere have, or 0."""
        begin, end = self.begin[terms], self.begin[terms + 1]
        terms = np.flatnonzero(end > begin)
        begin, end = begin[terms], end[terms]
        lower = np.zeros(len(self.doc_ids), np.int64)
        seen = np.zeros((len(terms), len(self.doc_ids)), bool)
        at, depth, wanted = begin.copy(), DEPTH, None
        while True:
            to = np.minimum(begin + depth, end)
            sizes = to - at
            where = np.repeat(to - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
            doc, impact = self.doc[where], self.impact[where]
            seen[np.repeat(np.arange(len(terms)), sizes), doc] = True
            lower += np.bincount(doc, weights=impact, minlength=len(lower)).astype(np.int64)  # sums far below 2**53
            at, depth = to, 2 * depth
            frontier = np.where(to < end, self.impact[np.maximum(to - 1, 0)], 0)
            met = np.flatnonzero(lower) if wanted is None else wanted
            if len(met) >= k:
                reach = max(reach, int(np.partition(lower[met], len(met) - k)[len(met) - k]))
            if wanted is None and frontier.sum() >= max(reach, 1):
                continue  # a document not seen yet may belong to the best
            upper = lower[met] + frontier.sum() - frontier @ seen[:, met]
            held = upper >= max(reach, 1)
            wanted = met[held]
            if not (upper[held] > lower[wanted]).any():
                return wanted, lower[wanted]


def _search(sent, k: int) -> Callable:
    """The k best documents of each item among a task's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight, items, n_docs, total = sent.value
        found: dict[int, list[tuple[int, bool, int]]] = {}

        def shard(rows: list[pa.RecordBatch]) -> None:
            ids = [x for b in rows for x in b.column("doc_id").to_pylist()]
            n = np.concatenate([b.column("n").to_numpy(zero_copy_only=False) for b in rows])
            sizes = np.concatenate([pc.list_value_length(b.column("terms")).to_numpy(zero_copy_only=False) for b in rows])
            term, tf = (np.concatenate([b.column(c).flatten().to_numpy(zero_copy_only=False) for b in rows]) for c in ("terms", "tf"))
            place = np.minimum(np.searchsorted(known, term), len(known) - 1)
            doc, own = np.repeat(np.arange(len(ids)), sizes), known[place] == term  # of this block's items
            place, doc, tf = place[own], doc[own], tf[own]
            m = 10 + 90 * n * n_docs // total
            impact = weight[place] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
            kept = impact > 0
            lists = Shard(ids, place[kept], doc[kept], impact[kept], len(known))
            for item, terms in items.items():
                before = found.get(item, [])
                docs, score = lists.best(terms, k, before[-1][0] if len(before) == k else 0)
                if len(docs):
                    new = [(s, ids[d] is None, ids[d]) for d, s in zip(docs.tolist(), score.tolist(), strict=True)]
                    found[item] = sorted(before + new, key=lambda x: (-x[0], x[1], x[2] or 0))[:k]

        rows, entries = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                rows.append(batch.slice(start, 1000))
                entries += len(rows[-1].column("terms").flatten())
                if entries >= SHARD:
                    shard(rows)
                    rows, entries = [], 0
        if entries:
            shard(rows)
        flat = [(item, i, s) for item, best in found.items() for s, _, i in best]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], pa.int64()) for j in range(3)], ["item", "doc_id", "score"])
        give_back()

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 for each item."""
    use_checkpoints(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    pairs = item_terms(items).checkpoint()
    blocks = max(1, -(-pairs.count() // block_pairs))
    texts, found = text_column(docs), None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "term").collect()
        known = np.array(sorted({r.term for r in own}), np.int64)
        sent = context.broadcast(known)
        indexed = texts.mapInArrow(_index(sent), INDEXED).checkpoint()
        numbers = indexed.select("n", "terms").mapInArrow(_totals(sent), "kind int, term long, n long").groupBy("kind", "term").agg(F.sum("n").alias("n")).collect()
        n_docs, total = (sum(r.n for r in numbers if r.kind == kind) for kind in (0, 1))
        df = {r.term: r.n for r in numbers if r.kind == 2}
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in known.tolist()], np.int64)
        by_item: dict[int, list[int]] = {}
        for r in own:
            by_item.setdefault(r.item, []).append(r.term)
        wanted = {item: np.searchsorted(known, np.array(sorted(terms), np.int64)) for item, terms in by_item.items()}
        ranked = indexed.mapInArrow(_search(context.broadcast((known, weight, wanted, n_docs, max(total, 1))), k), "item long, doc_id long, score long")
        found = ranked if found is None else found.union(ranked)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = pairs.select(F.col("item").alias("its_item"), "item_id").distinct()
    return best.join(names, F.expr("item = its_item")).select("item_id", "rank", "doc_id", "score")
