"""What a reviewer is told about a doubtful row: that the doubt is a false alarm, with the reason, or what to check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import Config
from . import guards as G
from . import periods
from . import text as T


def header_column(header: Column, period: Column) -> Column:
    """The column of a table's header, from one, that names a period: cell by cell, or in the order of a line's periods; 0 for none."""
    cells = F.transform(F.split(header, r" \| "), lambda c: F.array_contains(periods.parse_periods(c), period))
    by_cell, by_order = F.array_position(cells, F.lit(True)), F.array_position(periods.parse_periods(header), period)
    return F.coalesce(F.when(header.contains(" | "), by_cell).otherwise(by_order), F.lit(0))


def _plain(x: Column) -> Column:
    """A number as short as it prints."""
    return F.regexp_replace(F.regexp_replace(F.round(x, 6).cast("decimal(38,6)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")


def expands(text: Column, low: Column, high: Column) -> Column:
    """The range that a printed centre with its spread makes, as words, if it is the stored one."""
    number = rf"[$€£]?\s*({T.NUMBER})\s*%?"
    pattern = rf"(?i){number}[^0-9]{{0,40}}?(?:plus or minus|\+/-|±)\s*{number}"
    centre, spread = (T.as_number(F.nullif(F.regexp_extract(text, pattern, g), F.lit(""))) for g in (1, 2))
    near = F.greatest(F.lit(1e-6), F.abs(low) * 1e-4, F.abs(high) * 1e-4)
    fits = (F.abs(centre - spread - low) <= near) & (F.abs(centre + spread - high) <= near)
    return F.when(fits, F.concat(F.lit("false alarm: ± expands to "), _plain(centre - spread), F.lit("-"), _plain(centre + spread)))


def suggested_note(doubt: Column, early: Column, period: Column, header: Column, text: Column, low: Column, high: Column, metric: Column, label: Column, config: Config) -> Column:
    """The note by the kind of doubt; a period that closed before it was stated comes first."""
    following = periods.next_period(period)
    next_one = F.when(following.isNull(), "CHECK: period closes before stated").otherwise(F.concat(F.lit("CHECK: "), period, F.lit(" closed before this was stated; likely "), following))
    column = header_column(header, period)
    words = F.regexp_extract_all(F.lower(metric), F.lit("[a-z0-9]+"), F.lit(0))
    named = (F.size(words) > 0) & F.forall(words, lambda w: F.contains(F.lower(label), w))
    guides = T.has_forward_term(text, config) & (F.size(periods.parse_periods(text)) > 0) & T.has_number_with_unit(text, config)
    return (
        F.when(early, next_one)
        .when(doubt == "wrong_period", F.when(column > 0, F.concat(F.lit("false alarm: period from header column "), column.cast("string"))).otherwise("CHECK: period"))
        .when(doubt == "wrong_value", F.coalesce(G.let(text, lambda t: expands(t, low, high)), F.lit("CHECK: value")))
        .when(doubt == "wrong_metric", F.when(named, "false alarm: metric in heading").otherwise("CHECK: metric"))
        .when(doubt == "not_guidance", F.when(guides, "false alarm: forward verb, period, number present").otherwise("CHECK: guidance"))
        .otherwise(F.concat(F.lit("CHECK: "), F.coalesce(F.nullif(doubt, F.lit("")), F.lit("other"))))
    )
