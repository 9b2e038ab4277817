"""Even samples: a number of rows a key, spread over its order, half of either kind where there are enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import ranked_in_parts


def even_by_kind(rows: DataFrame, key: str, first_kind: Column, part: Column, order: list[Column], k: int) -> DataFrame:
    """``k`` rows of each key: half of the first kind and half of the other, each short kind's places going to the other.

    Of ``n`` rows of a kind in order, the places ``int((i + 0.5) * n / wanted)`` are taken.  Rows are numbered in parts, so a busy key is
    spread; only counts meet by key.
    """
    rows = rows.withColumn("kind__", F.coalesce(first_kind, F.lit(False)))
    sizes = rows.groupBy(key).agg(F.count_if("kind__").alias("a"), F.count_if(~F.col("kind__")).alias("b"))
    half = F.least("a", F.lit(k // 2))
    other = F.least(F.col("b"), F.lit(k) - half)
    sizes = sizes.select(key, F.explode(F.array(F.struct(F.lit(True).alias("kind__"), F.col("a").alias("n"), F.least(F.col("a"), F.lit(k) - other).alias("want")), F.struct(F.lit(False).alias("kind__"), F.col("b").alias("n"), other.alias("want")))).alias("s")).select(key, "s.*")
    places = F.transform(F.sequence(F.lit(0).cast("long"), F.col("want") - 1), lambda i: F.floor((2 * i + 1) * F.col("n") / (2 * F.col("want"))) + 1)
    wanted = sizes.where("want > 0").select(key, "kind__", F.explode(places).alias("place__"))
    ranked = ranked_in_parts(rows, [key, "kind__"], [part], order, "place__")
    return ranked.join(wanted, [key, "kind__", "place__"]).drop("kind__", "place__")
