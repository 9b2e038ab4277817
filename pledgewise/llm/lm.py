"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation.

Words are counted over all training documents.  The outputs of the neural part are the end of a text, the ``n_model`` most
frequent words, and one class for each of the ``ENDINGS`` groups in which all other words fall by their last two bytes.
A word of a class has the class's probability in its context times its smoothed share of the class, so every word
of the corpus, however many there are, has a probability that depends on the two tokens before it, and each class keeps a
share for words that were never seen.

A token's log-odds is bilinear in its vector and those of the two tokens before it, plus a bias; training needs no sums over
outputs, as it tells real tokens from draws of the unigram distribution.  All training text is learned from: it is dealt
by hash to rounds and shards, whose number follows from the number of tokens alone.  In each round every shard takes Adagrad
steps from the same parameters, in the order of the rows' hashes, and Spark averages the results by tokens seen; so the
model does not depend on how the table is cut, and the driver holds one set of parameters.  Scoring is normalised: as the
logits are sums over the two context places, the normalisers of all contexts are one matrix product of exponentials.

The base score is a smoothed unigram.  Counts of at most ``n_hot`` frequent words are broadcast; the rest of a document's
words meet their counts in a join keyed by word, which has no hot keys since those are broadcast.

Defined cases: a null or wordless text is one end token; rows with a null id are learned from and not held out; repeated
rows get a row each; with nothing to learn from, every count is zero and the model is uniform over its outputs.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, slices, text_column, use_checkpoints

END, ENDINGS = 0, 255
FIRST = 1 + ENDINGS  # the first frequent word among the outputs
DIM, NOISE, BATCH, RATE = 16, 64, 1024, 0.25
FLUSH, KEPT = 300_000, 400_000
ROUNDS, SHARD_TOKENS = 3, 2_000_000
CHUNK, MIXED = 1 << 16, 1 << 16  # tokens of a text in one row; tokens that are shuffled together


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def ending(word: bytes) -> int:
    """The class of a word that is not frequent."""
    return 1 + zlib.crc32(word[-2:]) % ENDINGS


def ending_of(word: Column) -> Column:
    """``ending`` of a column of words."""
    return (F.crc32(F.substring(word.cast("binary"), -2, 2)) % ENDINGS + 1).cast("int")


class Outputs(dict):
    """The output of each word; classes of other words are kept for as many as ``KEPT``."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i + FIRST) for i, w in enumerate(words))

    def __missing__(self, word: bytes) -> int:
        found = ending(word)
        if len(self) < KEPT:
            self[word] = found
        return found


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all documents; each task adds up what it reads before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                found.update(tokens(text))
            if len(found) > FLUSH:
                yield flushed()
        yield flushed()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the frequent words, most frequent first; the first ``n_model`` are outputs of their own."""

    words: list[bytes]
    counts: np.ndarray
    n_model: int
    n_docs: int
    total: int
    distinct: int
    rest: np.ndarray  # by class: tokens, and distinct words, of all words that are no outputs of their own

    @property
    def outputs(self) -> int:
        return FIRST + self.n_model

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def unigram(self) -> np.ndarray:
        """Smoothed probabilities of the outputs."""
        n = np.concatenate([[self.n_docs], self.rest[0], self.counts[: self.n_model]]) + 0.5
        return n / n.sum()

    def mass(self) -> np.ndarray:
        """What the smoothed counts of a class's words, with one unseen, add up to; by output, of classes alone."""
        out = np.ones(FIRST)
        out[1:] = self.rest[0] + 0.5 * (self.rest[1] + 1)
        return out


def vocabulary(counts: DataFrame, n_docs: int, n_hot: int, n_model: int) -> Vocabulary:
    """Frequent words down to the count at which they would be more than ``n_hot``."""
    level = F.floor(F.log2("n") * 8).cast("int")
    found = counts.groupBy(level.alias("level"), ending_of(F.col("word")).alias("ending")).agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    of_level: Counter = Counter()
    rest = np.zeros((2, ENDINGS))
    for r in found:
        of_level[r.level] += r.k
        rest[:, r.ending - 1] += r.n, r.k
    held, least = 0, None
    for k in sorted(of_level, reverse=True):
        if held + of_level[k] > n_hot:
            break
        held, least = held + of_level[k], k
    hot = counts.where(level >= least).collect() if least is not None else []
    hot = sorted(((r.n, r.word.encode()) for r in hot), key=lambda x: (-x[0], x[1]))
    n_model = min(n_model, len(hot))
    for n, w in hot[:n_model]:
        rest[:, ending(w) - 1] -= n, 1
    return Vocabulary([w for _, w in hot], np.array([n for n, _ in hot], np.int64), n_model, n_docs, sum(r.n for r in found) + n_docs, sum(of_level.values()) + (n_docs > 0), rest)


class Bilinear:
    """Vectors of the outputs (``out``, ``bias``) and of the tokens one and two places before (``near``, ``far``)."""

    def __init__(self, unigram: np.ndarray, seed: int = 5):
        rng, n = np.random.default_rng(seed), len(unigram)
        self.noise = unigram
        self.parts = {
            "out": rng.normal(0, 0.5, (n, DIM)).astype(np.float32),
            "near": rng.normal(0, 0.5, (n + 1, DIM)).astype(np.float32),
            "far": rng.normal(0, 0.5, (n + 1, DIM)).astype(np.float32),
            "bias": np.log(unigram).astype(np.float32)[:, None],
        }
        self.squares = {k: np.full(len(v), 0.1, np.float32) for k, v in self.parts.items()}
        self.cumulative = np.cumsum(unigram)
        self.offset = np.log(NOISE * unigram).astype(np.float32)

    def _update(self, name: str, at: np.ndarray, gradient: np.ndarray) -> None:
        order = np.argsort(at, kind="stable")
        at = at[order]
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        total = np.add.reduceat(gradient[order], begin, axis=0)
        at = at[begin]
        self.squares[name][at] += (total**2).mean(axis=1)
        self.parts[name][at] -= RATE * total / np.sqrt(self.squares[name][at])[:, None]

    def learn(self, word: np.ndarray, near: np.ndarray, far: np.ndarray, rng: np.random.Generator) -> None:
        """One step: tell these tokens from NOISE draws shared by the batch."""
        p = self.parts
        drawn = np.minimum(np.searchsorted(self.cumulative, rng.random(NOISE)), len(self.noise) - 1).astype(word.dtype)
        context, target, other = p["near"][near] + p["far"][far], p["out"][word], p["out"][drawn]
        real = np.einsum("ij,ij->i", context, target) + p["bias"][word, 0] - self.offset[word]
        fake = context @ other.T + p["bias"][drawn, 0] - self.offset[drawn]
        real, fake = -1 / (1 + np.exp(real)), 1 / (1 + np.exp(-fake))
        step = real[:, None] * target + fake @ other
        self._update("near", near, step)
        self._update("far", far, step)
        both = np.concatenate([word, drawn])
        self._update("out", both, np.concatenate([real[:, None] * context, fake.T @ context]))
        self._update("bias", both, np.concatenate([real, fake.sum(axis=0)])[:, None])

    def learn_all(self, word: np.ndarray, near: np.ndarray, far: np.ndarray, seed: int) -> None:
        """Steps over all these tokens in an order drawn from ``seed``."""
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(word))
        for at in range(0, len(word), BATCH):
            take = order[at : at + BATCH]
            self.learn(word[take], near[take], far[take], rng)

    def log_sums(self) -> np.ndarray:
        """The log normaliser of every pair of context tokens, near by far."""
        near, far = (self.parts[k] @ self.parts["out"].T for k in ("near", "far"))
        far += self.parts["bias"][:, 0]
        high = near.max(axis=1), far.max(axis=1)
        return np.log(np.exp(near - high[0][:, None]) @ np.exp(far - high[1][:, None]).T) + high[0][:, None] + high[1]

    def logits(self, word: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        p = self.parts
        return np.einsum("ij,ij->i", p["near"][near] + p["far"][far], p["out"][word]) + p["bias"][word, 0]

    def rows(self, seen: int) -> Iterator[pa.RecordBatch]:
        """Parameters and sums of squares as rows."""
        for name, part in self.parts.items():
            wide = np.zeros((len(part), DIM + 1))
            wide[:, : part.shape[1]], wide[:, DIM] = part, self.squares[name]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(part)), pa.array(np.arange(len(part), dtype=np.int32)), pa.array(np.full(len(part), float(seen))), *[pa.array(wide[:, d]) for d in range(DIM + 1)]],
                ["name", "at", "seen", *VALUES],
            )

    def take(self, rows: list) -> None:
        """Parameters and sums of squares from averaged rows."""
        for r in rows:
            part = self.parts[r.name]
            part[r.at] = np.array(r[2 : 2 + part.shape[1]], np.float32)
            self.squares[r.name][r.at] = r[2 + DIM]


VALUES = [f"v{d}" for d in range(DIM + 1)]


def _contexts(ids: list[np.ndarray], begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some texts in a row, each with the two before it in its text."""
    flat = np.concatenate([np.concatenate([np.array([begin, begin], x.dtype), x]) for x in ids])
    keep = np.flatnonzero(flat != begin)
    return flat[keep], flat[keep - 1], flat[keep - 2]


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``doc_id, row_hash, chunk, ids``: outputs as 16-bit numbers, at most CHUNK of a text in a row, after the two before them."""
    sent = docs.sparkSession.sparkContext.broadcast(vocab.words[: vocab.n_model])
    begin = vocab.outputs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = Outputs(sent.value).__getitem__
        for batch in slices(batches):
            at, chunk, data = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = tokens(text)
                ids = np.fromiter(map(get, words), np.uint16, len(words))
                ids = np.concatenate([np.array([begin, begin], np.uint16), ids, np.array([END], np.uint16)])
                for k in range(2, len(ids), CHUNK):
                    at.append(row)
                    chunk.append(k)
                    data.append(ids[k - 2 : k + CHUNK].tobytes())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("row_hash").take(at), pa.array(chunk, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "row_hash", "chunk", "ids"])

    keyed = docs.select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("row_hash"), "text")
    return keyed.mapInArrow(run, "doc_id long, row_hash long, chunk long, ids binary")


def train(docs: DataFrame, vocab: Vocabulary, shard_tokens: int = SHARD_TOKENS, rounds: int = ROUNDS) -> Bilinear:
    """The model after ``rounds`` rounds that each read their own part of the training text."""
    shards = max(1, -(-vocab.total // (rounds * shard_tokens)))
    key = F.xxhash64("doc_id", "row_hash", "chunk")
    rows = encoded(docs, vocab).select(key.alias("key"), "ids").checkpoint()
    model = Bilinear(vocab.unigram())
    for turn in range(rounds):
        dealt = rows.where(F.pmod(F.shiftrightunsigned("key", 40), F.lit(rounds)) == turn).withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            import copy

            now, fitted, held, size, seen = None, None, [], 0, 0

            def learn() -> None:
                nonlocal held, size, seen
                word, near, far = (np.concatenate(x) for x in zip(*held, strict=True))
                fitted.learn_all(word, near, far, seen + turn)
                held, size, seen = [], 0, seen + len(word)

            for batch in batches:
                for shard, data in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                    if shard != now:
                        if now is not None:
                            if held:
                                learn()
                            yield from fitted.rows(seen)
                        now, fitted, seen = shard, copy.deepcopy(sent.value), 0
                    ids = np.frombuffer(data, np.uint16)
                    held.append((ids[2:], ids[1:-1], ids[:-2]))
                    size += len(ids) - 2
                    if size >= MIXED:
                        learn()
            if now is not None:
                if held:
                    learn()
                yield from fitted.rows(seen)

        columns = ", ".join(f"{v} double" for v in VALUES)
        spread = dealt.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "key", "ids").select("shard", "ids")
        fitted = spread.mapInArrow(run, f"name string, at int, seen double, {columns}")
        mean = fitted.groupBy("name", "at").agg(*[(F.sum(F.col(v) * F.col("seen")) / F.sum("seen")).alias(v) for v in VALUES])
        model.take(mean.collect())
    return model


def _score(sent) -> Callable:
    """A row for each text with what the broadcast words decide, and a row for each of its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model, log_sum = sent.value
        outside = Outputs([])
        own_of = np.array([i + FIRST if i < vocab.n_model else ending(w) for i, w in enumerate(vocab.words)] + [END], np.int64)
        get, begin = vocab.index().get, vocab.outputs
        logs, log_mass = np.log10(vocab.counts + 0.5), np.log10(vocab.mass())
        log_end, per_token = math.log10(vocab.n_docs + 0.5), math.log10(vocab.total + 0.5 * (vocab.distinct + 1))
        for batch in slices(batches):
            n, known, base, score, word, count, owner, ids = [], [], [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                words = tokens(text)
                place = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                own, unseen = own_of[place], np.flatnonzero(place < 0).tolist()
                own[unseen] = [outside[words[i]] for i in unseen]
                rare = Counter([words[i] for i in unseen])
                word += [w.decode() for w in rare]
                count += rare.values()
                owner += [row] * len(rare)
                ids.append(np.append(own, END))
                seen = logs[place[place >= 0]]
                n.append(len(words) + 1)
                known.append(int((place >= 0).sum()) + (vocab.n_docs > 0))
                base.append(float(seen.sum()) + log_end - n[-1] * per_token)
                score.append(float(logs[place[place >= vocab.n_model]].sum()) - float(log_mass[own[own < FIRST]].sum()))
            token, near, far = _contexts(ids, begin)
            natural = model.logits(token, near, far).astype(np.float64) - log_sum[near, far]
            ends = np.cumsum(n)
            score = np.array(score) + np.add.reduceat(natural, np.concatenate([[0], ends[:-1]])) / math.log(10)
            ids_of, keys = batch.column("doc_id"), batch.column("row_hash")
            nothing = pa.nulls(batch.num_rows, pa.string())
            names = ["doc_id", "row_hash", "word", "n", "n_tokens", "n_known", "base", "score"]
            yield pa.RecordBatch.from_arrays([ids_of, keys, nothing, pa.array([1] * batch.num_rows, pa.int64()), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(score)], names)
            if word:
                at, zero = pa.array(owner, pa.int64()), pa.array(np.zeros(len(word), np.int64))
                zeros = pa.array(np.zeros(len(word)))
                yield pa.RecordBatch.from_arrays([ids_of.take(at), keys.take(at), pa.array(word), pa.array(count, pa.int64()), zero, zero, zeros, zeros], names)

    return run


def score_texts(docs: DataFrame, held_out: Column | None = None, n_hot: int = 200_000, n_model: int = 1792) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: log10 probabilities of each whole text."""
    use_checkpoints(docs.sparkSession)
    docs = text_column(docs)
    out_of = F.coalesce(id_remainder(F.col("doc_id"), 5) == 1, F.lit(False)) if held_out is None else held_out
    training = docs.where(~out_of)
    counts = count_words(training).checkpoint()
    vocab = vocabulary(counts, training.count(), n_hot, n_model)
    model = train(training, vocab)
    sent = docs.sparkSession.sparkContext.broadcast((vocab, model, model.log_sums()))
    keyed = docs.withColumn("row_hash", F.coalesce(F.xxhash64("text"), F.lit(0)))
    parts = keyed.mapInArrow(_score(sent), "doc_id long, row_hash long, word string, n long, n_tokens long, n_known long, base double, score double")
    # rows without a word get a key of their own, which no word can equal as it holds a space
    key = F.coalesce("word", F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.col("row_hash").cast("string")))
    met = parts.withColumn("key", key).join(counts.select(F.col("word").alias("key"), F.col("n").alias("c")), "key", "left")
    is_text = F.col("word").isNull()
    log_count = F.when(~is_text, F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).otherwise(0.0)
    rows = (
        met.groupBy("doc_id", "row_hash")
        .agg(
            F.sum(F.when(is_text, 1).otherwise(0)).alias("copies"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(~is_text & F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + log_count).alias("base_score"),
            F.sum(F.col("score") + log_count).alias("score"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    return rows.select(
        "doc_id",
        out_of.alias("held_out"),
        (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies")).alias("score"),
    )
