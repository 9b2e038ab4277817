"""Vector code compression: product codes whose nearest entries are found by equal-average search.

A vector of whole numbers is cut into equal parts, and each part is written as the number of the nearest entry of its position's
codebook.  Nearest means by squared Euclidean distance, and the lower index of equally near entries.

Equal-average search: a codebook is sorted by the sums of its entries' components.  For a part, the entries are visited outward from the
place of its own sum, on either side, and a side ends once the squared gap of the sums over the dimension is strictly
more than the best distance, as no later entry can then be as near.  Parts are visited together, a step outward at a time,
and those that have ended leave the arrays.

Codebooks start as the parts of the rows of the smallest ids.  In each round every row is assigned where it lies, each task adds up its own
parts by entry, and only these sums, of the codebooks' fixed size, are shuffled and given to the driver; no row moves.

Defined cases: vectors that are null, or hold null or non-finite components, are dropped; vectors shorter than the longest, and lengths that
the parts do not divide, are filled with zeros; components beyond 2**26 (for parts of 16, less for longer ones) are held there, so that no
sum of squares overflows; rows of fewer distinct ids than entries give fewer entries; equal ids are ordered by their vectors, rows without an id
come last; repeated rows count as often as they stand; a label's error beyond 64 bits is held at the largest long; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, use_checkpoints
from .vectors import integers, log2_up, vector_rows

#: Parts visited together; labels up to this number are sent to all tasks, more are met by a salted join.
TOGETHER, BROADCAST, SALTS = 4096, 200_000, 64


def _whole(column: pa.Array, scale: int, parts: int, width: int) -> np.ndarray:
    """Whole numbers by row, part and position, small enough that all squares and sums below fit 62 bits."""
    return integers(column, scale, parts * width, (60 - 2 * log2_up(width)) // 2).reshape(-1, parts, width)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each part's nearest entry and the squared distance; the lower index of equally near ones."""
    width = book.shape[1]
    order = np.argsort(book.sum(axis=1), kind="stable")
    entries, sums = book[order], book.sum(axis=1)[order]
    index, distance = np.full(len(parts), len(book)), np.full(len(parts), (1 << 62) // width)
    for at in range(0, len(parts), TOGETHER):
        own, best, arg = parts[at : at + TOGETHER], distance[at : at + TOGETHER], index[at : at + TOGETHER]
        total = own.sum(axis=1)
        right = np.searchsorted(sums, total)
        sides = [(np.arange(len(own)), right, 1), (np.arange(len(own)), right - 1, -1)]
        while sides:
            later = []
            for rows, place, way in sides:
                inside = (place >= 0) & (place < len(book))
                rows, place = rows[inside], place[inside]
                near = (sums[place] - total[rows]) ** 2 <= best[rows] * width
                rows, place = rows[near], place[near]
                if not len(rows):
                    continue
                gap = own[rows] - entries[place]
                found, number = np.einsum("ij,ij->i", gap, gap), order[place]
                better = (found < best[rows]) | ((found == best[rows]) & (number < arg[rows]))
                best[rows[better]], arg[rows[better]] = found[better], number[better]
                later.append((rows, place + way, way))
            sides = later
    return index, distance


def _assigned(batch: pa.RecordBatch, books: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts of a batch, and their entries and distances: by row and part."""
    n, _, width = books.shape
    parts = _whole(batch.column("v"), scale, n, width)
    found = [nearest(np.ascontiguousarray(parts[:, p]), books[p]) for p in range(n)]
    return parts, np.stack([x for x, _ in found], axis=1), np.stack([x for _, x in found], axis=1)


def _sums(sent, scale: int) -> Callable:
    """Of a task's rows, how many parts go to each entry and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        counts, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            parts, entry, _ = _assigned(batch, books, scale)
            for p in range(len(books)):
                np.add.at(sums[p], entry[:, p], parts[:, p])
                counts[p] += np.bincount(entry[:, p], minlength=books.shape[1])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(sums[part, entry].tolist(), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])
        give_back()

    return run


def fit(rows: DataFrame, width: int, parts: int, entries: int, rounds: int, scale: int) -> np.ndarray:
    """The codebooks ``[part, entry, position]`` after ``rounds`` rounds; none without rows."""
    context = rows.sparkSession.sparkContext
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    start = _whole(pa.array([r.v for r in first], pa.list_(pa.float64())), scale, parts, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(rounds if first else 0):
        sent = context.broadcast(books)
        found = rows.select("v").mapInArrow(_sums(sent, scale), "part int, entry int, n long, s array<long>")
        totals = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(width)]).alias("s")).collect()
        books = books.copy()
        for r in totals:
            books[r.part, r.entry] = np.array(r.s, np.int64) // r.n
        sent.destroy()
    return books


def _codes(sent, scale: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, entry, distance = _assigned(batch, sent.value, scale)
            code = [x.tobytes().hex() for x in entry.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(distance.sum(axis=1))], ["vec_id", "label", "code", "error"])
        give_back()

    return run


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the error summed over the rows of the same label, those without one together."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy(F.col("label").alias("its_label")).agg(total.alias("label_error")).checkpoint()
    if sums.count() <= BROADCAST:
        return coded.join(F.broadcast(sums), F.expr("label <=> its_label"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))  # a label may hold a third of the rows
    many = sums.withColumn("its_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(many, F.expr("label <=> its_label and salt = its_salt"))


def encode(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every row that is kept, and the codebooks; at most 256 entries."""
    use_checkpoints(vectors.sparkSession)
    rows = vector_rows(vectors, id_col, vector_col, F.col(label_col).alias("label"))
    longest = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0)).alias("n")).first().n
    books = fit(rows, max(1, -(-longest // parts)), parts, entries, rounds, scale)
    schema = f"vec_id long, label {rows.schema['label'].dataType.simpleString()}, code string, error long"
    coded = rows.mapInArrow(_codes(vectors.sparkSession.sparkContext.broadcast(books), scale), schema).checkpoint()
    return with_label_error(coded).select("vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")), books
