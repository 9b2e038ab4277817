"""Joins that Spark has no operator for, as compositions of equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, key: str, low: Column, high: Column, at: str, closed_low: bool = False) -> DataFrame:
    """Pairs with equal ``key`` whose ``right.at`` lies in ``(low, high]`` of the left row (``[low, high]`` if ``closed_low``).

    The left row is entered under each month its window touches, the right row under its own month; a pair meets in one
    month alone.  So a busy key is spread over its months, and a window of 550 days costs at most twenty entries.  Windows
    with a null or inverted bound have no pairs.  Columns of the two sides must differ but for ``key``.
    """
    entered = (
        left.withColumns({"low__": low, "high__": high})
        .where(F.col("low__").isNotNull() & F.col("high__").isNotNull() & (F.col("low__") <= F.col("high__")))
        .withColumn("month__", F.explode(F.sequence(F.trunc("low__", "MM"), F.trunc("high__", "MM"), F.expr("interval 1 month"))))
    )
    lower = F.col(at) >= F.col("low__") if closed_low else F.col(at) > F.col("low__")
    met = entered.join(right.where(F.col(at).isNotNull()).withColumn("month__", F.trunc(at, "MM")), [key, "month__"])
    return met.where(lower & (F.col(at) <= F.col("high__"))).drop("month__", "low__", "high__")


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` should end in a unique column."""
    name = rank or "rank__"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    ranked = ranked.where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def join_within(left: DataFrame, right: DataFrame, within: str, key: str, name: str) -> DataFrame:
    """Left rows with the right row of their ``key``, one at most, as the struct ``name``; null where there is none.

    Both sides have ``within``, a coarser key of few rows that a pair shares.  Right rows are gathered by it and meet there, so sides that
    already lie by it, as those made by one join on it, are not moved again.
    """
    gathered = right.groupBy(within).agg(F.collect_list(F.struct(*[c for c in right.columns if c != within])).alias("of__"))
    met = left.join(gathered, within, "left")
    return met.withColumn(name, F.get(F.filter("of__", lambda x: x[key] == F.col(key)), F.lit(0))).drop("of__")


def replace_scope(old: DataFrame, new: DataFrame, scope: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the rows of the scope's keys, and all of ``new``; applying it twice is applying it once."""
    return old.join(scope.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def replace_by_id(old: DataFrame, new: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of the listed ids replaced by position among their id, new ones added, vanished ones dropped, others kept."""
    spot = Window.partitionBy(key).orderBy("pos")
    values = [c for c in old.columns if c not in (key, "pos")]
    listed = ids.select(key).distinct()
    before = old.join(listed, key, "left_semi").withColumn("occurrence__", F.row_number().over(spot)).select(key, "occurrence__", F.col("pos").alias("old_pos__"))
    after = new.join(listed, key, "left_semi").withColumn("occurrence__", F.row_number().over(spot))
    last = old.agg(F.coalesce(F.max("pos"), F.lit(-1)).alias("last__"))
    merged = after.join(before, [key, "occurrence__"], "left").crossJoin(F.broadcast(last))
    merged = merged.select(key, F.coalesce("old_pos__", F.col("pos") + F.col("last__") + 1).alias("pos"), *values)
    return old.join(listed, key, "left_anti").select(key, "pos", *values).unionByName(merged)


def ranked_in_parts(df: DataFrame, keys: list[str], part: list[Column], order: list[Column], name: str) -> DataFrame:
    """Row numbers within each key in the order of ``part`` and then ``order``, without bringing a key's rows together.

    Rows are numbered within each part of a key; how many rows lie in a key's earlier parts is added.  Only the parts' counts are
    ordered as a whole.  Keys and parts must not be null.
    """
    names = [f"part{i}__" for i in range(len(part))]
    df = df.withColumns(dict(zip(names, part, strict=True)))
    sizes = df.groupBy(*keys, *names).agg(F.count("*").alias("n__"))
    earlier = Window.partitionBy(*keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before__", F.coalesce(F.sum("n__").over(earlier), F.lit(0))).drop("n__")
    local = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys, *names).orderBy(*order)))
    return local.join(sizes, [*keys, *names]).withColumn(name, F.col(name) + F.col("before__")).drop("before__", *names)


def running_sum(df: DataFrame, value: Column, part: Column, order: list[Column], name: str) -> DataFrame:
    """The sum of ``value`` over all rows up to each in the order of ``part`` and then ``order``, worked out part by part."""
    df = df.withColumns({"part__": part, "value__": value})
    sums = df.groupBy("part__").agg(F.sum("value__").alias("sum__"))  # parts alone meet in one place
    sums = sums.withColumn("before__", F.coalesce(F.sum("sum__").over(Window.orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("sum__")
    local = F.sum("value__").over(Window.partitionBy("part__").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn(name, local).join(sums, "part__").withColumn(name, F.col(name) + F.col("before__")).drop("part__", "value__", "before__")


def counted_before(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, name: str, same_day: bool = True) -> DataFrame:
    """Adds to ``left`` how many rows of ``right`` with its keys lie before ``at``, those of the same day included if ``same_day``.

    Both sides are put in one order, month by month, so that a key is spread over its months; no pair is ever made.  Left rows
    with a null day get 0.
    """
    rows = left.select(*keys, F.col(at).alias("at__"), F.struct("*").alias("row__"), F.lit(0).alias("right__"))
    marks = right.where(F.col(right_at).isNotNull()).select(*keys, F.col(right_at).alias("at__"), F.lit(None).cast(rows.schema["row__"].dataType).alias("row__"), F.lit(1).alias("right__"))
    both = rows.unionByName(marks).withColumn("month__", F.coalesce(F.trunc("at__", "MM"), F.lit("0001-01-01").cast("date")))
    sizes = both.groupBy(*keys, "month__").agg(F.sum("right__").alias("n__"))
    earlier = Window.partitionBy(*keys).orderBy("month__").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before__", F.coalesce(F.sum("n__").over(earlier), F.lit(0))).drop("n__")
    order = F.desc("right__") if same_day else F.asc("right__")
    running = F.sum("right__").over(Window.partitionBy(*keys, "month__").orderBy("at__", order).rowsBetween(Window.unboundedPreceding, 0))
    counted = both.withColumn("own__", running).where("right__ = 0").join(sizes, [*keys, "month__"])
    return counted.select("row__.*", (F.col("own__") + F.col("before__")).alias(name))


def next_rows(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, tie: str, n: int, same_day: bool = False) -> DataFrame:
    """Each left row with the first ``n`` right rows of its keys after ``at`` (on it too if ``same_day``), and their ``rank``.

    Right rows are numbered per key by day and ``tie``; a left row's place among them gives the numbers that it meets, so the
    work is ``n`` rows a left row, however many right rows a key has.  Columns of the two sides must differ but for ``keys``.
    """
    numbered = ranked_in_parts(right.where(F.col(right_at).isNotNull()), keys, [F.trunc(right_at, "MM")], [F.col(right_at), F.col(tie)], "place__")
    placed = counted_before(left.where(F.col(at).isNotNull()), right, keys, at, right_at, "passed__", same_day=not same_day)
    wanted = placed.withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("place__", F.col("passed__") + F.col("rank"))
    return wanted.join(numbered, [*keys, "place__"]).drop("place__", "passed__")
