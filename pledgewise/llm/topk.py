"""Exact top-k search by inner product: branch and bound over vertical blocks.

Rows are dealt evenly, without a key, into blocks of bounded size, kept dimension by dimension; queries likewise.  Each pair of a
query block and a candidate block is a cell and a group of two rows, so a task holds one cell, whatever the table's size.

In a cell, dimensions are taken by falling mass.  Scores are accumulated one block of dimensions at a time for all candidates of a few
queries at once.  After each block the k leaders of a query are scored to the end, which gives a score that k candidates reach; a
candidate stays only if its partial score plus the most that its remaining mass allows (the product of the norms of the
dimensions to come) reaches that score too.  Once few are left, survivors are compacted into pairs, and only those are carried through
the later blocks.  A bound never removes a candidate that could tie, so scores and ties are exact.

Components are ``floor(scale * x)``, and all scores are whole numbers: 64-bit floats hold them exactly while squared norms stay below
2**53, and cells with larger ones use 64-bit integers.

Defined cases: vectors that are null, or hold null or non-finite components, take no part; shorter vectors count as filled with zeros,
empty ones too; components beyond 2**28 (for 64 dimensions, less for more) are held there, so that no score overflows; rows
without an id are candidates after all others of the same score, but no queries; every query row has a list of its own, and rows of
its own id are not its candidates; repeated rows are candidates each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, use_checkpoints
from .vectors import integers, log2_up, vector_rows

#: Most bytes of a packed block; dimensions taken at a time; queries of a cell that are worked on together.
BLOCK_BYTES, STEP, TOGETHER = 16 << 20, 16, 128
#: Share of candidates left under which survivors are compacted into pairs.
SPARSE = 0.25
BLOCK = "block int, ids array<long>, wide boolean, body binary"
FOUND = "q int, slot int, query_id long, vec_id long, score long"


def _pack(scale: int, width: int) -> Callable:
    """A partition as one block: ids, and components dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            parts.append(integers(batch.column("v"), scale, width, (62 - log2_up(width)) // 2))
        if not ids:
            return
        body = np.ascontiguousarray(np.concatenate(parts).T)
        wide = bool(np.abs(body).max(initial=0) >= 1 << 24)  # beyond what 32-bit floats hold exactly
        packed = body.astype(np.int64 if wide else np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([wide]), pa.array([packed], pa.binary())], ["block", "ids", "wide", "body"])

    return run


def pack(rows: DataFrame, n: int, most: int, scale: int, width: int) -> tuple[DataFrame, int]:
    """Blocks of about ``most`` of the ``n`` rows, and how many there are."""
    blocks = max(1, -(-n // most))
    return rows.select("vec_id", "v").repartition(blocks).mapInArrow(_pack(scale, width), BLOCK).checkpoint(), blocks


def _suffix_norms(body: np.ndarray, steps: range) -> np.ndarray:
    """Norms of what is left after each block of dimensions, the last of them zero."""
    squares = np.stack([(body[i : i + STEP].astype(np.float64) ** 2).sum(axis=0) for i in steps])
    return np.sqrt(np.concatenate([np.cumsum(squares[::-1], axis=0)[::-1][1:], np.zeros((1, body.shape[1]))]))


def best(queries: np.ndarray, candidates: np.ndarray, same: Callable[[slice], np.ndarray], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (query, candidate, score) among which are the k best of every query with all that tie; both sides dimension by dimension.

    ``same(part)`` says for a slice of queries which candidates are their own.
    """
    mass = (queries.astype(np.float64) ** 2).sum(axis=1) * (candidates.astype(np.float64) ** 2).sum(axis=1)
    order = np.argsort(-mass, kind="stable")
    large = max((queries.astype(np.float64) ** 2).sum(axis=0).max(), (candidates.astype(np.float64) ** 2).sum(axis=0).max()) >= 2.0**53
    kind = np.int64 if large else np.float64
    queries, candidates = queries[order].astype(kind), candidates[order].astype(kind)
    steps = range(0, len(order), STEP)
    rest_q, rest_c = _suffix_norms(queries, steps), _suffix_norms(candidates, steps)
    for at in range(0, queries.shape[1], TOGETHER):
        own = queries[:, at : at + TOGETHER]
        n, m = own.shape[1], candidates.shape[1]
        alive = ~same(slice(at, at + n))
        reach = np.full(n, -np.inf)
        partial, left = np.zeros((n, m), kind), 0
        for step, i in enumerate(steps):
            partial += own[i : i + STEP].T @ candidates[i : i + STEP]
            left = step + 1
            if left == len(steps):
                break
            if m > k:
                leaders = np.argpartition(np.where(alive, partial, np.iinfo(np.int64).min if large else -np.inf), m - k, axis=1)[:, m - k :]
                full = np.einsum("dq,dqk->qk", own, candidates[:, leaders])
                enough = np.take_along_axis(alive, leaders, axis=1).all(axis=1)
                reach = np.where(enough, np.maximum(reach, full.min(axis=1).astype(np.float64)), reach)
            room = np.outer(rest_q[step, at : at + n], rest_c[step])
            alive &= partial + room + 1e-9 * (room + np.abs(reach, where=np.isfinite(reach), out=np.zeros(n))[:, None]) + 1 >= reach[:, None]
            if alive.mean() <= SPARSE:
                break
        q, c = np.nonzero(alive)
        score = partial[q, c]
        for step in range(left, len(steps)):  # survivors alone, compacted after every block of dimensions
            i = steps[step]
            score = score + np.einsum("dp,dp->p", own[i : i + STEP, q], candidates[i : i + STEP, c])
            room = rest_q[step, at + q] * rest_c[step, c]
            held = score + room + 1e-9 * (room + np.abs(np.where(np.isfinite(reach), reach, 0))[q]) + 1 >= reach[q]
            q, c, score = q[held], c[held], score[held]
        yield at + q, c, score.astype(np.int64)


def _search(k: int) -> Callable:
    """The k best of each query of a cell, its query block being the row of kind 0 and its candidates that of kind 1."""

    def run(cell: pa.Table) -> pa.Table:
        sides = {}
        for row in cell.select(["kind", "q", "ids", "wide", "body"]).to_pylist():
            body = np.frombuffer(row["body"], np.int64 if row["wide"] else np.float32)
            sides[row["kind"]] = (row["q"], row["ids"], body.reshape(-1, len(row["ids"])))
        empty = pa.table({name: pa.array([], pa.int32() if name in ("q", "slot") else pa.int64()) for name in ("q", "slot", "query_id", "vec_id", "score")})
        if len(sides) < 2:
            return empty
        (block, query_ids, queries), (_, ids, candidates) = sides[0], sides[1]
        unnamed = np.array([x is None for x in ids])
        numbers, asked = np.array([x or 0 for x in ids], np.int64), np.array(query_ids, np.int64)
        out = [[], [], []]
        for q, c, score in best(queries, candidates, lambda part: (asked[part][:, None] == numbers) & ~unnamed, k):
            order = np.lexsort((numbers[c], unnamed[c], -score, q))
            q, c, score = q[order], c[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            for kept, x in zip(out, (q, c, score), strict=True):
                kept.append(x[rank < k])
        q, c, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
        give_back()
        return pa.table([pa.array(np.full(len(q), block, np.int32)), pa.array(q.astype(np.int32)), pa.array(asked[q]), pa.array(numbers[c], mask=unnamed[c]), pa.array(score)], empty.schema)

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", candidate_rows: int | None = None, query_rows: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of highest inner product for each row whose id is divisible by ``every``."""
    use_checkpoints(vectors.sparkSession)
    rows = vector_rows(vectors, id_col, vector_col)
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    size = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("queries"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    width = max(1, size.width)
    most = max(1, BLOCK_BYTES // (8 * width))
    candidates, n_c = pack(rows, size.n, min(most, max(2048, size.n // 64)) if candidate_rows is None else candidate_rows, scale, width)
    queries, n_q = pack(rows.where(is_query), size.queries, min(most, query_rows), scale, width)
    cells = [
        queries.select(F.lit(0).alias("kind"), F.col("block").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(n_c - 1))).alias("c"), "ids", "wide", "body"),
        candidates.select(F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("q"), F.col("block").alias("c"), "ids", "wide", "body"),
    ]
    found = cells[0].union(cells[1]).groupBy("q", "c").applyInArrow(_search(k), FOUND)
    order = Window.partitionBy("q", "slot").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
