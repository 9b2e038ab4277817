"""Encoding texts into pieces of a fixed vocabulary, and decoding them.

A text is segmented so that the scores of its pieces add up to the most.  An Aho-Corasick automaton over the pieces reads
each word once; at every position the output links give all pieces that end there, and each relaxes the best score of the
position.  A character without a piece becomes its bytes, at ten below the least score.  No piece holds a space after another
character, so texts fall apart into words before spaces without loss; a distinct word is segmented once per task and kept
in a bounded table.

Decoding concatenates the pieces' bytes and drops the leading space that encoding puts before a text; it restores every
text exactly.  One pass, no shuffles.

Defined cases: null texts have null ids and decode to null; an empty text has no ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes, text_column
from .pieces import PATH, Automaton, Vocabulary, blocks, load

KEPT = 400_000
WORDS = re.compile(r"\n| +[^ \n]*|[^ \n]+")


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        if any("\n" in p or " " in p.lstrip(" ") for p in vocabulary.pieces):
            raise ValueError("words are cut before spaces and around line ends; no piece may cross that")
        self.vocabulary, self.automaton = vocabulary, Automaton(vocabulary.pieces)
        self.missing = float(vocabulary.scores.min()) - 10
        self.single = np.array(sorted(ord(p) for p in vocabulary.pieces if len(p) == 1), np.int64)
        a = self.automaton
        self.score = np.where(a.piece >= 0, vocabulary.scores[np.maximum(a.piece, 0)], 0.0)
        self.known: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.known.clear()
        self.ids, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def segment(self, words: list[str]) -> list[list[int]]:
        """For each word the ids of its best segmentation."""
        out: list[list[int]] = [[] for _ in words]
        depth, piece = self.automaton.depth, self.automaton.piece
        for numbers, chars, sizes in blocks(words):
            n, wide = chars.shape
            best = np.full((n, wide + 1), -np.inf)
            back = np.full((n, wide + 1), -1, np.int32)
            best[:, 0] = 0
            has = np.isin(chars, self.single)
            for j, active, outputs in self.automaton.walk(chars, sizes):
                best[:active, j + 1] = np.where(has[:active, j], -np.inf, best[:active, j] + self.missing)
                for rows, states in outputs:
                    value = best[rows, j + 1 - depth[states]] + self.score[states]
                    more = value > best[rows, j + 1]
                    best[rows[more], j + 1], back[rows[more], j + 1] = value[more], states[more]
            at, rows, steps = sizes.copy(), np.arange(n), []
            while len(rows := rows[at[rows] > 0]):
                state = back[rows, at[rows]]
                steps.append((rows, np.where(state >= 0, piece[np.maximum(state, 0)], -1 - chars[rows, at[rows] - 1])))
                at[rows] -= np.where(state >= 0, depth[np.maximum(state, 0)], 1)
            if not steps:
                continue
            row, value = np.concatenate([r for r, _ in steps]), np.concatenate([v for _, v in steps])
            order = np.lexsort((-np.arange(len(row)), row))
            bounds = np.searchsorted(row[order], np.arange(n + 1))
            value = value[order]
            ids = np.where(value >= 0, self.vocabulary.ids[np.maximum(value, 0)], value).tolist()
            for k, number in enumerate(numbers):
                own = ids[bounds[k] : bounds[k + 1]]
                if min(own, default=0) < 0:
                    own = [b for i in own for b in ([i] if i >= 0 else self.vocabulary.byte_ids[list(chr(-1 - i).encode())].tolist())]
                out[number] = own
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin."""
        if len(self.known) > KEPT:
            self._clear()
        words = [WORDS.findall(f" {t}") if t else [] for t in texts]
        new = list({w for ws in words for w in ws}.difference(self.known))
        if new:
            found = self.segment(new)
            base, sizes = len(self.known), np.array([len(x) for x in found], np.int64)
            self.known.update(zip(new, range(base, base + len(new)), strict=True))
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.array([i for x in found for i in x], np.int32)])
        place = np.array([self.known[w] for ws in words for w in ws], np.int64)
        sizes = self.begin[place + 1] - self.begin[place]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[place] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.concatenate([[0], np.cumsum([len(ws) for ws in words])])
        return ids, np.concatenate([[0], ends])[per_text]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        texts = [b""] * (int(max(vocabulary.ids.max(initial=0), vocabulary.byte_ids.max())) + 1)
        for i, p in zip(vocabulary.ids, vocabulary.pieces, strict=True):
            texts[i] = p.encode()
        for b, i in enumerate(vocabulary.byte_ids):
            if i >= 0:
                texts[i] = bytes([b])
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts in a row, each without its leading space, and where each begins."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        data = self.data[np.repeat(self.begin[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[begin]
        full = bounds[1:] > bounds[:-1]
        keep = np.ones(len(data), bool)
        keep[bounds[:-1][full]] = False
        return data[keep], bounds - np.concatenate([[0], np.cumsum(full)])


def encode(docs: DataFrame, path: str = PATH) -> DataFrame:
    """``doc_id, ids`` for each whole text."""
    return _encoded(docs, path).select("doc_id", "ids")


def decode(encoded: DataFrame, path: str = PATH) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    sent = encoded.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in batches:
            column = batch.column("ids")
            lists = [np.array(x or [], np.int64) for x in column.to_pylist()]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            data, bounds = decoder.decode(np.concatenate([*lists, np.zeros(0, np.int64)]), begin)
            raw = data.tobytes()
            texts = [raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(bounds, bounds[1:], column.is_valid().to_pylist(), strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(sent.value), Decoder(sent.value)
        for batch in slices(batches):
            texts = batch.column("text")
            ids, begin = encoder.encode(texts.to_pylist())
            data, bounds = decoder.decode(ids, begin)
            raw, offsets = text_bytes(texts)
            same = np.array_equal(bounds, offsets) and np.array_equal(data, raw)
            back, source = data.tobytes(), raw.tobytes()
            equal = [True] * len(texts) if same else [back[a:b] == source[c:d] for a, b, c, d in zip(bounds, bounds[1:], offsets, offsets[1:], strict=False)]
            lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()), mask=texts.is_null())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    lists,
                    pa.array(np.diff(begin)),
                    pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]),
                    pa.array(equal),
                ],
                ["doc_id", "ids", "n_tokens", "decoded_sha256", "round_trip"],
            )

    return text_column(docs).mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, decoded_sha256 string, round_trip boolean")


def encode_and_check(docs: DataFrame, path: str = PATH) -> DataFrame:
    """``doc_id, ids, n_tokens, decoded_sha256, round_trip``: ids, and what decoding them gives back."""
    return _encoded(docs, path)
