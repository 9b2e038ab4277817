"""Vector columns as integers: which rows take part, and Arrow list columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """A vector that is neither null nor holds a null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def vector_rows(vectors: DataFrame, id_col: str, vector_col: str, *carry: str) -> DataFrame:
    """``vec_id, v`` (doubles) and the carried columns of the rows that take part; no other column can clash."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), *carry)
    return rows.where(usable(F.col("v")))


def integers(column: pa.Array, scale: int, width: int, bits: int) -> np.ndarray:
    """``floor(scale * x)`` of every component, held within two to the power ``bits``, a row each, with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64) * scale)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), at] = np.clip(values, -(2.0**bits), 2.0**bits)
    return out


def log2_up(n: int) -> int:
    return max(n - 1, 0).bit_length()
