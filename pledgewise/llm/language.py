"""Language identification by unigrams of pieces, marginalised over segmentations.

Each language gives every piece of a fixed public vocabulary a probability, fitted by expectation-maximisation (expected
piece counts from forward and backward sums over all segmentations) on a bounded sample of its texts: about ``per_language``
texts, less where they are long, so that a language gives about ``per_language * max_chars`` characters at most; texts of more than
``20 * max_chars`` are not sampled, but the shortest text of a language always is.  The languages and their shares are counted over
all learnable rows.  In fitting, runs of more than ``PART`` letters are learned from in parts of that size.  A word's probability under a language is the sum over all its segmentations, which a
forward pass along the Aho-Corasick automaton computes for all languages at once; a text's is the product over its words, and
the score is the share of the predicted language, with the languages' shares of documents as prior.

Scoring is one pass over whole texts without shuffles; a distinct word is summed once per task and kept in a bounded table.

A letter is a character of a Unicode letter category; digits, fractions and circled numbers are none.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as are all texts when there is nothing to learn
from; rows with a null id are scored and not held out; null languages are not learned from; ties go to the first language
in order of name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_remainder, slices
from .pieces import PATH, Automaton, blocks, load

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = 1e-7  # probability of a character that no piece holds, in every language
KEPT, RESCALE, PART, FARTHEST = 400_000, 16, 200, 600.0


def _letters(found: str) -> list[str]:
    """The runs of letters in what the pattern took for a word: other numerals than digits pass it."""
    return "".join(c if c.isalpha() else " " for c in found).split(" ")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = WORD.findall((text or "").lower())
    return found if all(map(str.isalpha, found)) else [w for f in found for w in ([f] if f.isalpha() else _letters(f)) if w]


def log_likelihood(words: list[str], automaton: Automaton, probability: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all segmentations of each word (after a space), a column for each language."""
    languages = probability.shape[1]
    out = np.zeros((len(words), languages))
    by_state = probability[np.maximum(automaton.piece, 0)]
    depth = automaton.depth
    for numbers, chars, sizes in blocks([f" {w}" for w in words], (1 << 21) // max(languages, 1)):
        n, wide = chars.shape
        total, scale = np.zeros((n, wide + 1, languages)), np.zeros((n, languages))
        total[:, 0] = 1
        for j, active, outputs in automaton.walk(chars, sizes):
            now = total[:active, j] * UNKNOWN
            for rows, states in outputs:
                now[rows] += total[rows, j + 1 - depth[states]] * by_state[states]
            total[:active, j + 1] = now
            if j % RESCALE == RESCALE - 1:
                low = max(j + 2 - 2 * RESCALE, 0)
                total[:active, low : j + 2] /= now[:, None]
                scale[:active] += np.log(now)
            done = slice(int(np.searchsorted(-sizes, -(j + 1), "left")), active)
            out[numbers[done]] = np.log(total[done, j + 1]) + scale[done]
    return out


class _Lattice:
    """Where pieces stand in a block of words: edges from ``start`` to ``end``, by either."""

    def __init__(self, automaton: Automaton, chars: np.ndarray, sizes: np.ndarray, times: np.ndarray):
        self.shape, self.sizes, self.times = chars.shape, sizes, times
        found = [(rows, np.full(len(rows), j + 1), states) for j, _, outputs in automaton.walk(chars, sizes) for rows, states in outputs]
        self.row, self.end, states = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ([], [], [])))
        self.start, self.piece = self.end - automaton.depth[states], automaton.piece[states]
        self.by_end, self.by_start = np.argsort(self.end, kind="stable"), np.argsort(self.start, kind="stable")
        place = np.arange(chars.shape[1] + 2)
        self.end_at, self.start_at = np.searchsorted(self.end[self.by_end], place), np.searchsorted(self.start[self.by_start], place)

    def expected(self, probability: np.ndarray) -> np.ndarray:
        """How often each edge is expected to be used, over all segmentations.

        Sums are kept as logarithms: along letters that no piece holds they fall by UNKNOWN each, and would soon be zero.
        """
        n, wide = self.shape
        p = probability[self.piece]
        ahead, behind = np.zeros((n, wide + 1)), np.zeros((n, wide + 1))
        for j in range(1, wide + 1):
            own = self.by_end[self.end_at[j] : self.end_at[j + 1]]
            row = self.row[own]
            gap = np.minimum(ahead[row, self.start[own]] - ahead[row, j - 1], FARTHEST)
            ahead[:, j] = ahead[:, j - 1] + np.log(UNKNOWN + np.bincount(row, weights=p[own] * np.exp(gap), minlength=n))
        for i in range(wide - 1, -1, -1):
            own = self.by_start[self.start_at[i] : self.start_at[i + 1]]
            row = self.row[own]
            gap = np.minimum(behind[row, self.end[own]] - behind[row, i + 1], FARTHEST)
            now = behind[:, i + 1] + np.log(UNKNOWN + np.bincount(row, weights=p[own] * np.exp(gap), minlength=n))
            behind[:, i] = np.where(i < self.sizes, now, 0)
        whole = ahead[np.arange(n), self.sizes]
        return self.times[self.row] * p * np.exp(np.minimum(ahead[self.row, self.start] + behind[self.row, self.end] - whole[self.row], FARTHEST))


def fit(texts: list[str], automaton: Automaton, n_pieces: int, rounds: int = 3, smooth: float = 0.05) -> np.ndarray:
    """Piece probabilities of one language."""
    counts = Counter(w[k : k + PART] for t in texts for w in words_of(t) for k in range(0, len(w), PART))
    times = np.array(list(counts.values()), np.float64)
    held = [_Lattice(automaton, chars, sizes, times[numbers]) for numbers, chars, sizes in blocks([f" {w}" for w in counts])]

    def shares(uses: list[np.ndarray]) -> np.ndarray:
        expected = sum((np.bincount(x.piece, weights=u, minlength=n_pieces) for x, u in zip(held, uses, strict=True)), np.full(n_pieces, smooth))
        return expected / expected.sum()

    probability = shares([x.times[x.row] for x in held])
    for _ in range(rounds):
        probability = shares([x.expected(probability) for x in held])
    return probability


def train(docs: DataFrame, learned: Column, path: str, per_language: int = 300, max_chars: int = 5000) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """Languages in order, log prior, piece probabilities by language, and the pieces."""
    vocabulary = load(path)
    known = docs.where(learned & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.length("text").alias("size"), F.xxhash64("doc_id", "text").alias("h"))
    short = F.col("size") <= 20 * max_chars
    totals = known.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(short).alias("k"), F.sum(F.when(short, F.col("size"))).alias("chars"), F.min(F.struct("size", "h")).alias("least")
    )
    found = {r.lang: r for r in totals.collect()}
    names = sorted(found)
    if not names:
        return [], np.zeros(0), np.zeros((len(vocabulary.pieces), 0)), vocabulary.pieces
    # hashes of rows below a share of their range are the sample; equal rows are one, so that it is bounded
    share = {name: min(1.0, per_language / max(r.k, 1), per_language * max_chars / max(r.chars or 0, 1)) for name, r in found.items()}
    drawn = F.coalesce(*[F.when(F.col("lang") == name, F.lit(share[name])) for name in names])
    least = F.coalesce(*[F.when(F.col("lang") == name, (F.col("size") == found[name].least["size"]) & (F.col("h") == found[name].least["h"])) for name in names])
    chosen = known.where((short & (F.pmod("h", F.lit(1_000_000)) < drawn * 1_000_000)) | least).select("lang", "text").distinct().collect()
    automaton = Automaton(vocabulary.pieces)
    texts = {name: sorted(r.text for r in chosen if r.lang == name) for name in names}
    fitted = np.stack([fit(texts[name], automaton, len(vocabulary.pieces)) for name in names], axis=1)
    prior = np.log(np.array([found[name].n for name in names]) / sum(r.n for r in found.values()))
    return names, prior, fitted, vocabulary.pieces


def identify(docs: DataFrame, held_out: Column | None = None, path: str = PATH, **bounds: int) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every whole text."""
    out_of = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False)) if held_out is None else held_out
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, ~out_of, path, **bounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, probability, pieces = sent.value
        automaton = Automaton(pieces)
        known: dict[str, int] = {}
        likely = np.zeros((0, len(names)))
        for batch in slices(batches):
            if len(known) > KEPT:
                known.clear()
                likely = likely[:0]
            words = [words_of(t) for t in batch.column("text").to_pylist()]
            new = list({w for ws in words for w in ws}.difference(known))
            if new and names:
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                likely = np.concatenate([likely, log_likelihood(new, automaton, probability)])
            pred, score = [], []
            for ws in words:
                if not ws or not names:
                    pred.append("und")
                    score.append(0.0)
                    continue
                odds = likely[[known[w] for w in ws]].sum(axis=0) + prior
                best = int(odds.argmax())
                pred.append(names[best])
                score.append(float(1 / np.exp(odds - odds[best]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double").select("doc_id", out_of.alias("held_out"), "lang_pred", "score")
