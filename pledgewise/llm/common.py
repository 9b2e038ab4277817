"""Pieces shared by the operators: input columns, checkpoints, and words of Arrow text columns as byte ranges.

Texts reach Python as Arrow batches.  ``slices`` cuts a batch so that a bounded number of text bytes is in work at a
time (one very long text is a slice of its own), and ``Words`` finds the words of a slice with array operations, so no
Python object is made per word unless an operator asks for it.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
_MULT = 0x9E3779B97F4A7C15 | 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; whatever else the table holds cannot clash with an operator's own columns."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def use_checkpoints(spark: SparkSession) -> None:
    """Checkpoint to the folder the cluster names; only a session of one machine without one gets its own.

    Raises on a cluster that names none, as a folder of one machine would lose data there.
    """
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() is not None:
        return
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))


def written(df: DataFrame, *sums: Column) -> tuple[DataFrame, Row]:
    """The table, checkpointed, and aggregates of it that are taken as it is written: no job reads it again for them."""
    seen = Observation()
    df = df.observe(seen, *sums).checkpoint()
    return df, Row(**seen.get)


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """Maps each byte to itself, separators to a space, and A-Z to a-z where asked."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[np.frombuffer(separators, np.uint8)] = 32
    return table


def slices(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of at most SLICE_BYTES of the named columns (``text`` if none is) or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns or ("text",))
        total = np.cumsum(lengths)
        at = 0
        while at < len(total):
            base = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, base + SLICE_BYTES, "right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def give_back() -> None:
    """Hands memory that the task no longer needs back to the system; Python workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (null: empty)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_MULT, -1, 1 << 64)
    ups, downs = (np.full(n, m, np.uint64) for m in (_MULT, inverse))
    ups[0] = downs[0] = 1
    return np.cumprod(ups), np.cumprod(downs)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash multiplier and of its inverse modulo 2**64."""
    return _powers(1 << max(16, int(n).bit_length()))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for each range, equal for equal content wherever it stands."""
    ups, downs = powers(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.multiply(values, ups[: len(values)], out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    return mix((total[ends] - total[starts]) * downs[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of a column of texts: bytes ``data[starts[i]:ends[i]]``; row r has words ``first[r]`` to ``first[r+1]``."""

    def __init__(self, texts: pa.Array, table: np.ndarray):
        raw, self.offsets = text_bytes(texts)
        self.data = table[raw]
        inside = self.data != 32
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(raw))]
        before[edges], after[edges - 1] = False, False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return range_hash(byte_values()[self.data], self.starts, self.ends)

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``n`` words inside one row."""
        left = np.repeat(self.first[1:], self.counts) - np.arange(len(self))
        at = np.flatnonzero(left >= n)
        return at, range_hash(hashes, at, at + n)

    def joined(self, row: int) -> bytes:
        """The row's words with one space between them."""
        return b" ".join(self.word_list(row))

    def word_list(self, row: int) -> list[bytes]:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().split()


def covered(at: np.ndarray, n: np.ndarray | int, total: int) -> np.ndarray:
    """Which of ``total`` positions lie in a run of ``n`` from some position in ``at``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return np.cumsum(change[:-1]) > 0
