"""Deduplicating drafts that state one thing several times, and naming those that disagree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["cik", "metric", "target_period", "stated_at"]
FIGURE = ["unit", "target_low", "target_high"]
# Dollar units and their scales.
DOLLARS = {"USD": 1.0, "USD thousands": 1e3, "USD millions": 1e6, "USD billions": 1e9}


def bound(value: Column, unit: Column) -> Column:
    """A bound as ``struct(shown, dollars, room)``: to six decimals, in dollars, and half of its last printed digit in dollars.

    Of the decimals that a float prints at least one counts; other units than dollars have neither dollars nor room.
    """
    scale = F.coalesce(*[F.when(unit == name, F.lit(x)) for name, x in DOLLARS.items()])
    decimals = F.length(F.regexp_extract(F.rtrim(F.format_string("%.10f", value), F.lit("0")), r"\.(\d*)$", 1))
    room = scale * F.pow(F.lit(10.0), -F.greatest(decimals, F.lit(1))) / 2
    return F.struct(F.round(value, 6).alias("shown"), (value * scale).alias("dollars"), (room * (1 + 1e-9)).alias("room"))


PAIRS = 1 << 18  # looked at in one step


def first_ranges(unit: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of figures in rank order the place of the first range that holds each point, of its unit and open where a bound is missing; -1 for none."""
    holder = np.full(len(unit), -1)
    points, ranges = np.flatnonzero(low == high), np.flatnonzero(~(low == high))
    bottom, top, own = np.where(np.isnan(low), -np.inf, low)[ranges], np.where(np.isnan(high), np.inf, high)[ranges], unit[ranges]
    step = max(1, PAIRS // max(len(ranges), 1))
    for k in range(0, len(points) if len(ranges) else 0, step):
        some = points[k : k + step]
        at = low[some][:, None]
        held = (unit[some][:, None] == own) & (bottom <= at) & (at <= top)
        holder[some] = np.where(held.any(1), ranges[held.argmax(1)], -1)
    return holder


def near_pairs(unit: np.ndarray, dollars: np.ndarray, room: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places, the earlier first, of figures in different dollar units whose bounds (two rows) lie within the coarser room, or are both missing.

    Figures are put in the order of a bound that they have, and meet those within the widest room after them.
    """
    pairs: list[tuple[int, int]] = []
    none = np.isnan(dollars)
    for shape in ((False, False), (True, False), (False, True)):
        at = np.flatnonzero((none[0] == shape[0]) & (none[1] == shape[1]))
        if len(at) < 2 or (unit[at] == unit[at[0]]).all():
            continue
        main = int(shape[0])
        at = at[np.argsort(dollars[main][at], kind="stable")]
        value = dollars[main][at]
        n = np.searchsorted(value, value + np.nanmax(room[main][at]), side="right") - np.arange(len(at)) - 1
        ends, k = np.cumsum(n), 0
        while k < len(at):
            to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + PAIRS, side="right")))
            count = n[k:to]
            x = np.repeat(np.arange(k, to), count)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
            x, y, k = at[x], at[y], to
            met = unit[x] != unit[y]
            for side in (0, 1):
                if not shape[side]:
                    met &= np.abs(dollars[side][x] - dollars[side][y]) <= np.fmax(room[side][x], room[side][y])
            pairs += zip(np.minimum(x, y)[met].tolist(), np.maximum(x, y)[met].tolist(), strict=True)
    return pairs


def first_leaders(unit: np.ndarray, shown: np.ndarray, dollars: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The place of the leader of each figure: in rank order, a figure that says the same as no earlier leader is one itself.

    Two say the same if they are equal as shown in one unit, or near each other in two dollar units (bounds as two rows, nan: missing).
    """
    leader = np.arange(len(unit))
    none = np.isnan(shown)
    own = np.where(none.all(0), -1, unit)  # without bounds units do not matter
    kinds = np.unique(np.column_stack([own, *none, *np.where(none, 0, shown)]), axis=0, return_inverse=True, return_counts=True)
    kind, many = kinds[1].reshape(-1), kinds[2]
    earlier: dict[int, list[int]] = {}
    for x, y in near_pairs(unit, dollars, room):
        earlier.setdefault(y, []).append(x)
    lead: dict[int, int] = {}
    for x in np.union1d(np.flatnonzero(many[kind] > 1), np.fromiter(earlier, int, len(earlier))).tolist():
        found = [y for y in earlier.get(x, []) if leader[y] == y] + [lead[k] for k in (kind[x],) if k in lead]
        if found:
            leader[x] = min(found)
        else:
            lead[kind[x]] = x
    return leader


JUDGED = T.StructType([T.StructField("holder", T.ArrayType(T.IntegerType())), T.StructField("leader", T.ArrayType(T.IntegerType())), T.StructField("many", T.BooleanType())])


def judge(unit: pd.Series, low: pd.Series, high: pd.Series, shown_low: pd.Series, shown_high: pd.Series, dollars_low: pd.Series, dollars_high: pd.Series, room_low: pd.Series, room_high: pd.Series) -> pd.DataFrame:
    """A key's figures in rank order, as arrays: by place the range that holds a point, the leader of others, and whether there is more than one leader."""
    out = []
    for u, *bounds in zip(unit, low, high, shown_low, shown_high, dollars_low, dollars_high, room_low, room_high, strict=True):
        u, values = np.asarray(u), np.array([np.asarray(x, dtype=float) for x in bounds]).reshape(4, 2, -1)
        holder = first_ranges(u, *values[0])
        rest = np.flatnonzero(holder < 0)
        leader = np.full(len(u), -1)
        leader[rest] = rest[first_leaders(u[rest], *values[1:, :, rest])]
        out.append((holder, leader, len(set(leader[rest].tolist())) > 1))
    return pd.DataFrame(out, columns=["holder", "leader", "many"])


def dedupe(drafts: DataFrame) -> DataFrame:
    """Every draft with ``outcome`` (kept, duplicate, or point in range), ``kept_by`` and ``conflict``.

    Drafts of one company, metric, period and day are ranked, sentences before sections.  A point inside a range of its
    unit gives way to the first such range.  The rest are clustered in rank order by their leaders' numbers; with more than
    one cluster all leaders are kept and marked.  What is gathered per key are its different figures, each with the first
    draft that states it, found by partial aggregation, and judged as arrays of numbers: points against ranges step by step, the rest by
    sorting.  Drafts learn their figure's verdict by a join.
    """
    rank = F.struct((F.col("capture_method") != "sentence").alias("section"), "char_start", "item_index", "draft_id")
    figures = drafts.groupBy(*KEYS, *FIGURE).agg(F.min(rank).alias("first"))
    entry = F.struct("first", *FIGURE, F.array(*[bound(F.col(c), F.col("unit")) for c in FIGURE[1:]]).alias("bounds"))
    keyed = figures.groupBy(*KEYS).agg(F.sort_array(F.collect_list(entry)).alias("all"))
    names = F.array_distinct(F.transform("all", lambda x: x["unit"]))
    units = F.transform("all", lambda x, i: F.coalesce(F.array_position(names, x["unit"]), -2 - i).cast("long"))  # one without a unit has its own

    def numbers(value) -> Column:
        return F.transform("all", lambda x: F.nanvl(value(x), F.lit(float("inf"))))

    own = [numbers(lambda x, c=c: x[c]) for c in FIGURE[1:]]
    read = [numbers(lambda x, k=k, name=name: x["bounds"][k][name]) for name in ("shown", "dollars", "room") for k in (0, 1)]
    keyed = keyed.withColumn("judged", F.pandas_udf(judge, JUDGED)(units, *own, *read))

    def at(place: Column) -> Column:
        return F.get("all", place)["first"]["draft_id"]

    places = F.arrays_zip("all", "judged.holder", "judged.leader")
    first = F.transform(places, lambda x: F.struct(*[x["all"][c].alias(c) for c in FIGURE], at(x["holder"]).alias("holder"), at(x["leader"]).alias("leader")))
    verdicts = keyed.select(*KEYS, F.col("judged.many").alias("many"), F.explode(first).alias("v")).select(*KEYS, "many", "v.*")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"v.{c}")) for c in [*KEYS, *FIGURE]]
    outcome = F.when(F.col("v.holder").isNotNull(), "point in range").when(F.col("v.leader") == F.col("d.draft_id"), "kept").otherwise("duplicate")
    return (
        drafts.alias("d")
        .join(verdicts.alias("v"), same)
        .select(*[F.col(f"d.{c}") for c in KEYS], F.col("d.draft_id"), outcome.alias("outcome"), F.coalesce("v.holder", "v.leader").alias("kept_by"), ((outcome == "kept") & F.col("v.many")).alias("conflict"))
    )
