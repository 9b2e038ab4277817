"""Quality scores from a factorisation machine.

Features are hashed words (square-root frequencies), statistics of structure (case, symbols, repetition, lines, lengths) and
metadata (the declared length against the real one).  The machine adds a bias, weights, and low-rank interactions of all
pairs of features, which the identity sum-of-pairs = (square of sum - sum of squares) / 2 scores in time linear in the features.
It learns from the whole texts of all labelled rows.
Their features are dealt by hash to shards of about ``SHARD`` values; in each of ``ROUNDS`` rounds every shard is fitted from the same start in a
task, and a feature's numbers are then averaged over the shards that hold it, by how many of their rows do.  So partitions do not matter.
Means and spreads of the statistics are of all learned rows, from exact sums.  Scoring is one pass over whole texts without shuffles.

Defined cases: null and wordless texts are scored from their structure alone (all zero); a null declared length counts as
the real one; rows with a null id are scored and not held out; labels that are null or not 0 or 1 are not learned from;
of several rows or labels of an id each is learned from;
with fewer than two classes to learn from every score is the share of class 1 (1 without labels, so nothing is rejected).
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, Words, byte_table, give_back, id_remainder, slices, text_bytes, use_checkpoints

BUCKETS, RANK = 1 << 15, 6
SHARD, ROUNDS, EPOCHS, BROADCAST = 400_000, 4, 8, 2_000_000
TABLE = byte_table(WHITESPACE, lower=True)
STATISTICS = ["upper", "digit", "symbol", "bar", "beyond_ascii", "space", "line", "distinct", "again", "word_length", "length", "words", "declared"]


def features(texts: pa.Array, declared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words as (row, bucket, value) with rows in order, and the statistics of each row."""
    words = Words(texts, TABLE)
    n_rows = len(texts)
    size = np.diff(words.offsets).astype(np.float64)
    raw, _ = text_bytes(texts)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[words.offsets[1:]] - total[words.offsets[:-1]]) / np.maximum(size, 1)

    hashes, rows, n = words.hashes(), words.rows, np.maximum(words.counts, 1)
    again = np.zeros(len(words), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    key = rows * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    row = key // BUCKETS
    letter = ((raw >= 97) & (raw <= 122)) | ((raw >= 65) & (raw <= 90))
    symbol = (raw > 32) & (raw < 127) & ~letter & ~((raw >= 48) & (raw <= 57))
    chars = size - np.round(share((raw & 0xC0) == 0x80) * size)
    declared = np.where(np.isnan(declared), chars, declared)
    statistics = np.stack(
        [
            share((raw >= 65) & (raw <= 90)),
            share((raw >= 48) & (raw <= 57)),
            share(symbol),
            share(raw == 124),
            share(raw >= 128),
            share(raw == 32),
            np.log1p(share(raw == 10) * size),
            np.bincount(row, minlength=n_rows) / n,
            np.bincount(rows[again], minlength=n_rows) / n,
            np.bincount(rows, weights=words.ends - words.starts, minlength=n_rows) / n,
            np.log1p(size),
            np.log1p(words.counts),
            np.log1p(np.maximum(declared, 0)) - np.log1p(chars),
        ],
        axis=1,
    )
    return row, key % BUCKETS, np.sqrt(count / n[row]), statistics


NUMBERS = ["weight", *[f"factor_{k}" for k in range(RANK)]]


class Machine:
    def __init__(self, seed: int = 7):
        rng, n = np.random.default_rng(seed), BUCKETS + len(STATISTICS)
        self.bias, self.weights = 0.0, np.zeros(n)
        self.factors = rng.normal(0, 0.02, (n, RANK))
        self.centre, self.width = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))

    def rows(self, found: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and standardised statistics as one list of (row, feature, value), by row."""
        row, bucket, value, statistics = found
        scaled = np.clip((statistics - self.centre) / self.width, -4, 4)
        n = len(statistics)
        row = np.concatenate([row, np.repeat(np.arange(n), len(STATISTICS))])
        at = np.concatenate([bucket, np.tile(BUCKETS + np.arange(len(STATISTICS)), n)])
        value = np.concatenate([value, scaled.ravel()])
        order = np.argsort(row, kind="stable")
        return row[order], at[order], value[order]

    def odds(self, row: np.ndarray, at: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each row, and the sums of its features' factors."""
        begin = np.searchsorted(row, np.arange(n))
        along = self.factors[at] * value[:, None]
        sums, squares = np.add.reduceat(along, begin, axis=0), np.add.reduceat(along**2, begin, axis=0)
        return self.bias + np.add.reduceat(self.weights[at] * value, begin) + (sums**2 - squares).sum(axis=1) / 2, sums

    def fit(self, found: tuple, labels: np.ndarray, cost: np.ndarray, epochs: int, rate: float = 0.05, batch: int = 64, decay: float = 1e-4) -> np.ndarray:
        """Learns rows of ``labels`` that count ``cost`` times, and gives in how many of them each feature is."""
        row, at, value = self.rows(found)
        n = len(labels)
        begin = np.searchsorted(row, np.arange(n + 1))
        square_w, square_f = np.full(len(self.weights), 1e-2), np.full(len(self.weights), 1e-2)
        rng = np.random.default_rng(1)
        for _ in range(epochs):
            order = rng.permutation(n)
            for k in range(0, n, batch):
                take = order[k : k + batch]
                held = np.concatenate([np.arange(begin[t], begin[t + 1]) for t in take])
                own = np.repeat(np.arange(len(take)), begin[take + 1] - begin[take])
                a, x = at[held], value[held]
                odds, sums = self.odds(own, a, x, len(take))
                error = (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels[take]) * cost[take] / len(take)
                each = error[own] * x
                touched, place = np.unique(a, return_inverse=True)
                g_w = np.bincount(place, weights=each) + decay * self.weights[touched]
                along = each[:, None] * (sums[own] - self.factors[a] * x[:, None])
                g_f = np.stack([np.bincount(place, weights=along[:, f]) for f in range(RANK)], axis=1) + decay * self.factors[touched]
                square_w[touched] += g_w**2
                square_f[touched] += (g_f**2).mean(axis=1)
                self.weights[touched] -= rate * g_w / np.sqrt(square_w[touched])
                self.factors[touched] -= rate * g_f / np.sqrt(square_f[touched])[:, None]
                self.bias -= rate * float(error.sum())
        return np.bincount(at, minlength=len(self.weights))

    def numbers(self, seen: np.ndarray, rows: int) -> pa.RecordBatch:
        """``at, seen`` and the numbers of each feature that was seen; the bias is at -1."""
        held = np.flatnonzero(seen)
        values = np.concatenate([[[self.bias] + [0.0] * RANK], np.column_stack([self.weights[held], self.factors[held]])])
        columns = [np.append(-1, held).astype(np.int32), np.append(rows, seen[held]).astype(np.float64), *values.T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], ["at", "seen", *NUMBERS])

    def take(self, mean: pa.Table) -> None:
        at, values = mean["at"].to_numpy(), np.column_stack([mean[c].to_numpy() for c in NUMBERS])
        self.bias = float(values[at < 0][0, 0])
        self.weights[at[at >= 0]], self.factors[at[at >= 0]] = values[at >= 0, 0], values[at >= 0, 1:]


def _columns(docs: DataFrame) -> DataFrame:
    declared = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), declared.alias("declared"))


def _declared(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, float("nan")).to_numpy(zero_copy_only=False)


def learned_rows(docs: DataFrame, labels: DataFrame, learned: Column) -> DataFrame:
    """``key, label, buckets, values, statistics``: the features of each labelled row, buckets as 16-bit and values as 32-bit numbers."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where(learned & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    known = known.checkpoint()
    rows = _columns(docs).join(F.broadcast(known) if known.count() <= BROADCAST else known, "doc_id").select(F.xxhash64("doc_id", "text").alias("key"), "label", "text", "declared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, bucket, value, statistics = features(batch.column("text"), _declared(batch.column("declared")))
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = [pa.array([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()) for x in (bucket.astype(np.uint16), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), *lists, pa.array(list(statistics), pa.list_(pa.float64()))], ["key", "label", "buckets", "values", "statistics"])

    return rows.mapInArrow(run, "key long, label int, buckets binary, values binary, statistics array<double>")


def _fitted(sent, cost: tuple[float, float], most: int, epochs: int):
    """Fits each shard from the model that was sent; a shard of several times its due is fitted in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, now = [], 0, None

        def learn() -> pa.RecordBatch:
            label, buckets, values, statistics = zip(*held, strict=True)
            n = [len(x) for x in buckets]
            model, truth = copy.deepcopy(sent.value), np.array(label)
            found = np.repeat(np.arange(len(n)), n), np.concatenate(buckets).astype(np.int64), np.concatenate(values).astype(np.float64), np.stack(statistics)
            seen = model.fit(found, truth, np.array(cost)[truth], epochs)
            return model.numbers(seen, len(truth))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "label", "buckets", "values", "statistics")]
            for shard, label, buckets, values, statistics in zip(*columns, strict=True):
                if held and (shard != now or size >= 2 * most):
                    yield learn()
                    held, size = [], 0
                now = shard
                held.append((label, np.frombuffer(buckets, np.uint16), np.frombuffer(values, np.float32), np.array(statistics)))
                size += len(held[-1][1]) + len(STATISTICS)
        if held:
            yield learn()

    return run


def train(docs: DataFrame, labels: DataFrame, learned: Column, shard: int = SHARD, rounds: int = ROUNDS) -> Machine:
    """The model of all rows that have a label and are ``learned``."""
    use_checkpoints(docs.sparkSession)
    shares = {r.label: r.n for r in labels.where(learned).groupBy(F.col("quality").cast("int").alias("label")).agg(F.count("*").alias("n")).collect() if r.label in (0, 1)}
    prior = shares.get(1, 0) / sum(shares.values()) if shares else 1.0
    rows = learned_rows(docs, labels, learned)
    each = rows.select("label", (F.length("buckets") / 2 + len(STATISTICS)).alias("size"), F.posexplode("statistics").alias("k", "x")).withColumn("x", F.col("x").cast("decimal(18,9)"))
    sums = sorted(each.groupBy("k").agg(F.count("*"), F.sum("label"), F.sum("size"), F.sum("x"), F.sum(F.col("x") * F.col("x"))).collect())
    n, ones, entries = sums[0][1:4] if sums else (0, 0, 0)
    model = Machine()
    if ones in (0, n):
        model.factors[:] = 0
        edge = min(max(prior, 1e-9), 1 - 1e-9)
        model.bias = float(np.log(edge / (1 - edge)))
        return model
    means = [Fraction(r[4]) / n for r in sums]
    spread = np.sqrt([float(Fraction(r[5]) / n - m * m) for r, m in zip(sums, means, strict=True)])
    model.centre = np.array([float(m) for m in means])
    model.width = np.where(spread > 1e-9, spread + 1e-6, np.inf)  # what never differs in training has no say
    model.bias = float(np.log(prior / (1 - prior)))
    shards = max(1, -(-int(entries) // shard))
    dealt = rows.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("key", "label", "buckets", "values", "statistics").drop("key").checkpoint()
    share = ones / n
    for _ in range(rounds):
        run = _fitted(docs.sparkSession.sparkContext.broadcast(model), ((1 - prior) / (1 - share), prior / share), shard, EPOCHS // rounds)
        fitted = dealt.mapInArrow(run, f"at int, seen double, {', '.join(f'{c} double' for c in NUMBERS)}")
        model = copy.deepcopy(model)
        model.take(fitted.groupBy("at").agg(*[(F.sum(F.col(c) * F.col("seen")) / F.sum("seen")).alias(c) for c in NUMBERS]).toArrow())
        give_back()
    return model


def keep_good(docs: DataFrame, labels: DataFrame, learned: Column | None = None, threshold: float = 0.3, **bounds: int) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all their columns; nothing is shuffled."""
    learned = ~F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)) if learned is None else learned
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, learned, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            found = features(batch.column("text"), _declared(pc.cast(batch.column("n_chars"), pa.float64())))
            odds, _ = model.odds(*model.rows(found), batch.num_rows)
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def score_texts(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3, **bounds: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text; higher scores are better texts."""
    out_of = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False)) if held_out is None else held_out
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, ~out_of, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches):
            found = features(batch.column("text"), _declared(batch.column("declared")))
            odds, _ = model.odds(*model.rows(found), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], ["doc_id", "score"])

    scored = _columns(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", out_of.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
