"""Toxicity scores from subword-bag embeddings.

A word is the mean of the vectors of its character n-grams and of itself; a text is the mean of
its distinct words, weighted by the roots of their counts; a linear softmax
reads the text.  Vectors and softmax are trained together by gradient descent in numpy on a bounded sample of labelled
rows (a number of rows of each class, of at most ``max_chars`` characters, the least by hash of the id), so a misspelling that was
never seen is scored by the n-grams it shares with words that were.  N-grams of very few texts keep no vector: fewer than one in
500 of the sample, and at most fewer than eight, so that a small sample is learned from whole.

As the softmax is linear, a word adds a fixed number to a text's log-odds: executors work that number out once per distinct
word and keep it in a bounded table.  Scoring is one pass without shuffles over whole texts.

Defined cases: null and wordless texts get the score of the bias alone; rows with a null id are scored and not held out;
labels that are null or not 0 or 1 are not learned from; with fewer than two classes to learn from every score is the
share of class 1 (0 without labels).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, id_remainder, slices, text_column
from .subwords import normal, subword_buckets

BUCKETS, DIM, SCALE, EPSILON = 1 << 17, 4, 20.0, 1e-6
CACHE = 400_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learned: Column, most: dict[int, int], max_chars: int, carry: tuple[str, ...] = ()) -> list:
    """At most ``most[label]`` rows ``doc_id, text, label`` and ``carry`` of each label, the least by hash of the id, whatever the partitions.

    Ids are drawn from those labels whose document is there, not empty and of at most ``max_chars`` characters; only ids are shuffled for
    that, and the texts of the drawn ids alone are fetched.  Of several rows of an id the least by hash of the text is taken.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry).where((F.length("text") <= max_chars) & (F.length("text") > 0))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(learned & F.col("doc_id").isNotNull() & F.col("label").isin(*most))
    usable = known.join(texts.select("doc_id"), "doc_id", "left_semi").distinct()
    chosen = None
    for value, n in most.items():
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = part if chosen is None else chosen.union(part)
    first = F.min_by(F.struct("text", *carry), F.struct(F.xxhash64("text"), "text", *carry))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(first.alias("one")).select("doc_id", "label", "one.*").collect()
    return sorted(rows, key=lambda r: (r.doc_id, r.label))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def counted(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and their weights in the text's mean: roots of counts, so that one word said over and over is not all."""
    found = Counter(words_of(text))
    return list(found), np.sqrt(np.fromiter(found.values(), np.float64, len(found)))


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows of each segment; segments may be empty."""
    out = np.zeros((len(begin) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(begin[1:] > begin[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, begin[:-1][full], axis=0)
    return out


class Bag:
    """The embeddings ``vectors``, and ``direction`` and ``bias`` of the softmax (as log-odds of class 1)."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.softmax = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, texts: list[str], labels: np.ndarray, prior: float, steps: int = 120, rate: float = 0.05, decay: float = 1e-4, least_docs: int | None = None) -> None:
        """Full-batch Adam steps; n-grams of fewer than ``least_docs`` texts keep no vector."""
        least_docs = max(1, min(8, len(texts) // 500)) if least_docs is None else least_docs
        place: dict[bytes, int] = {}
        word, doc, weight = [], [], []
        for d, text in enumerate(texts):
            words, n = counted(text)
            word.append(np.array([place.setdefault(w, len(place)) for w in words], np.int32))
            doc.append(np.full(len(n), d, np.int32))
            weight.append(n / max(n.sum(), 1))
        word, doc, weight = np.concatenate(word), np.concatenate(doc), (np.concatenate(weight) * SCALE).astype(np.float32)[:, None]
        subword, begin = subword_buckets([normal(w) for w in place], BUCKETS)
        size = np.diff(begin)
        owner = np.repeat(np.arange(len(place)), size)
        docs_of = np.bincount(subword, weights=np.bincount(word, minlength=len(place))[owner], minlength=BUCKETS)
        self.vectors[docs_of < least_docs] = 0
        held = docs_of[subword] >= least_docs
        subword, owner = subword[held].astype(np.int32), owner[held].astype(np.int32)
        del held
        begin = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(place)))])
        share = (1 / size).astype(np.float32)[:, None]
        used, subword = np.unique(subword, return_inverse=True)
        subword = subword.astype(np.int32)
        by_doc = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])
        to_word, to_subword = np.argsort(word, kind="stable").astype(np.int32), np.argsort(subword, kind="stable").astype(np.int32)
        by_word = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(place)))])
        by_subword = np.concatenate([[0], np.cumsum(np.bincount(subword, minlength=len(used)))])
        doc_by_word, weight_by_word, owner_by_subword = doc[to_word], weight[to_word], owner[to_subword]
        del to_word, to_subword
        truth = np.eye(2, dtype=np.float32)[labels]
        share_1 = labels.mean()
        cost = np.where(labels == 1, prior / share_1, (1 - prior) / (1 - share_1)).astype(np.float32)[:, None]
        vectors = self.vectors[used]
        self.bias[:] = np.log([1 - prior, prior])
        params = (vectors, self.softmax, self.bias)
        mean, square = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
        for step in range(1, steps + 1):
            words = _sums(vectors[subword], begin) * share
            bags = _sums(words[word] * weight, by_doc)
            logits = bags @ self.softmax + self.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - truth) * cost / len(texts)
            back = error @ self.softmax.T
            to_words = _sums(back[doc_by_word] * weight_by_word, by_word) * share
            gradients = (_sums(to_words[owner_by_subword], by_subword) + decay * vectors, bags.T @ error, error.sum(axis=0))
            for k, (x, g) in enumerate(zip(params, gradients, strict=True)):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                x -= rate * (1 - 0.8 * step / steps) * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + EPSILON)
        self.vectors[used] = vectors

    def along(self) -> np.ndarray:
        """What a word made of one n-gram adds to the log-odds of a text that holds nothing else."""
        return self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0]) * SCALE


def word_odds(words: list[bytes], along: np.ndarray) -> np.ndarray:
    """What each word adds to the log-odds of a text that holds nothing else."""
    subword, begin = subword_buckets(words, len(along))
    return _sums(along[subword], begin) / np.diff(begin)


def train(docs: DataFrame, labels: DataFrame, learned: Column, positives: int = 1500, negatives: int = 4000, max_chars: int = 8000) -> tuple[Bag, int]:
    """The model, and how many classes it has seen; the sample's bounds are ``positives``, ``negatives`` and ``max_chars``."""
    shares = {r.label: r.n for r in labels.where(learned).groupBy(F.col("toxic").cast("int").alias("label")).agg(F.count("*").alias("n")).collect() if r.label in (0, 1)}
    prior = shares.get(1, 0) / max(sum(shares.values()), 1)
    sample = labelled_sample(docs, labels, "toxic", learned, {0: negatives, 1: positives}, max_chars)
    model, truth = Bag(), np.array([r.label for r in sample], np.int64)
    if len(set(truth.tolist())) < 2:
        model.vectors[:] = 0
        edge = min(max(prior, 1e-9), 1 - 1e-9)
        model.bias[:] = np.log([1 - edge, edge])
        return model, len(set(truth.tolist()))
    model.fit([r.text for r in sample], truth, prior)
    del sample
    give_back()
    return model, 2


def _score(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        along, bias = sent.value
        known: dict[bytes, float] = {}
        for batch in slices(batches):
            texts = [counted(t) for t in batch.column("text").to_pylist()]
            if len(known) > CACHE:
                known.clear()
            new = list({w for words, _ in texts for w in words}.difference(known))
            if new:
                known.update(zip(new, word_odds([normal(w) for w in new], along).tolist(), strict=True))
            odds = np.array([n @ np.fromiter(map(known.__getitem__, words), np.float64, len(words)) / max(n.sum(), 1) for words, n in texts]) + bias
            score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def score_texts(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3, **bounds: int) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every whole text."""
    out_of = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)) if held_out is None else held_out
    model, _ = train(docs, labels, ~out_of, **bounds)
    sent = docs.sparkSession.sparkContext.broadcast((model.along(), float(model.bias[1] - model.bias[0])))
    scored = text_column(docs).mapInArrow(_score(sent), "doc_id long, score double")
    return scored.select("doc_id", out_of.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
