"""Order statistics of a column without sorting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPANS, FEW = 4096, 50_000


def value_at(values: DataFrame, value: str, weight: str, position: int) -> float | None:
    """The value at a place (from zero) of the sorted column in which each row of ``values`` stands ``weight`` times.

    The range is cut into equal spans, counted, and narrowed to the span that holds the place until few rows are left, so
    outliers cost a round each and no task sees all values.  Give it a table that is written; it is read once a round.
    """
    v, w = F.col(value), F.col(weight)
    low, high, rows, total = values.agg(F.min(v), F.max(v), F.count("*"), F.sum(w)).first()
    if not rows or not 0 <= position < total:
        return None
    inside, before = values, 0
    while rows > FEW and high > low:
        place = F.least(F.floor((v - low) / (high - low) * SPANS), F.lit(SPANS - 1))
        found = sorted(inside.groupBy(place.alias("s")).agg(F.sum(w).alias("n"), F.min(v).alias("a"), F.max(v).alias("b"), F.count("*").alias("k")).collect(), key=lambda r: r.s)
        for r in found:
            if position < before + r.n:
                low, high, rows = r.a, r.b, r.k
                break
            before += r.n
        inside = values.where(v.between(low, high))
    for r in inside.select(v.alias("v"), w.alias("n")).orderBy("v").collect():
        before += r.n
        if position < before:
            return r.v
    return None
