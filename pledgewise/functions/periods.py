"""Fiscal calendars and period labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL = r"^(?:Q([1-4]) )?FY(\d{4})$"
ORDINALS = ("first", "second", "third", "fourth")


def period_end(month: Column, named_for_end: Column, year: Column, quarter: Column) -> Column:
    """Last day of the month a fiscal year (null quarter) or quarter ends in; null when the calendar is unknown."""
    end_year = F.when(named_for_end | (month == 12), year).otherwise(year + 1)
    return F.last_day(F.add_months(F.make_date(end_year, month, F.lit(1)), -3 * (4 - F.coalesce(quarter, F.lit(4)))))


def parse_period(label: Column) -> Column:
    """``struct(quarter, year)`` of a label such as ``Q3 FY2024``; both null for anything else."""
    return F.struct(_part(label, 1).alias("quarter"), _part(label, 2).alias("year"))


def _part(label: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(label, LABEL, group), F.lit("")).cast("int")


def quarter_of(label: Column) -> Column:
    return _part(label, 1)


def year_of(label: Column) -> Column:
    return _part(label, 2)


def format_period(quarter: Column, year: Column) -> Column:
    return F.when(quarter.isNull(), F.concat(F.lit("FY"), year.cast("string"))).otherwise(F.concat(F.lit("Q"), quarter.cast("string"), F.lit(" FY"), year.cast("string")))


def next_period(label: Column) -> Column:
    quarter, year = quarter_of(label), year_of(label)
    return F.when(year.isNotNull(), format_period(F.when(quarter == 4, 1).otherwise(quarter + 1), F.when(quarter.isNull() | (quarter == 4), year + 1).otherwise(year)))


def fiscal_year_reported(month: Column, named_for_end: Column, quarter: Column, filed_at: Column, max_days: int = 150) -> Column:
    """The year whose quarter (null: the year itself) ended last before the filing, if within ``max_days``.

    Four years can hold it; the ends rise with the year, so the last one that lies before the filing wins.
    """
    years = [F.year(filed_at) + k for k in (1, 0, -1, -2)]
    ends = [(y, period_end(month, named_for_end, y, quarter)) for y in years]
    best_year = F.coalesce(*[F.when(end < filed_at, y) for y, end in ends])
    best_end = F.coalesce(*[F.when(end < filed_at, end) for _, end in ends])
    return F.when(F.datediff(filed_at, best_end) <= max_days, best_year)


def fiscal_label_for_end(month: Column, named_for_end: Column, end: Column, quarterly: bool) -> Column:
    """The label of the period that ends on a date, placed by the month a week earlier; null if none ends then."""
    target = F.last_day(F.date_sub(end, 7))
    year = F.year(target)
    quarters = [F.lit(q) for q in (1, 2, 3, 4)] if quarterly else [F.lit(None).cast("int")]
    return F.coalesce(*[F.when(period_end(month, named_for_end, year + k, q) == target, format_period(q, year + k)) for k in (-1, 0, 1, 2) for q in quarters])


def year_in(text: Column) -> Column:
    """The first year of this century that a label names."""
    return F.nullif(F.regexp_extract(text, r"(20\d\d)", 1), F.lit("")).cast("int")


def closes_before_stated(month: Column, named_for_end: Column, label: Column, stated_at: Column) -> Column:
    return F.coalesce(period_end(month, named_for_end, year_of(label), quarter_of(label)) < stated_at, F.lit(False))


#: Fixed values: ``Q2 2023``, ``4Q23``, ``FY26``, ``Full Year 2023``, ``first quarter of fiscal 2024``.
ANY_LABEL = (
    r"(?i)\bQ[1-4] ?(?:FY|fiscal )?(?:20\d\d|\d\d)\b|\b[1-4]Q ?(?:FY)?(?:20\d\d|\d\d)\b"
    r"|\b(?:first|second|third|fourth) quarter (?:of )?(?:fiscal )?(?:year )?20\d\d\b|\b(?:FY ?|fiscal (?:year )?|full[- ]year )(?:20\d\d|\d\d)\b"
)


def parse_periods(text: Column) -> Column:
    """Labels in order of appearance, normalised: ``Q2 2023``, ``4Q23``, ``FY26``, ``Full Year 2023``, ``first quarter of fiscal 2024``."""

    def label(found: Column) -> Column:
        low = F.lower(found)
        digits = F.regexp_extract(low, r"(\d+)$", 1)
        year = F.when(F.length(digits) == 4, digits).otherwise(F.concat(F.lit("20"), F.substring(digits, -2, 2)))
        number = F.coalesce(
            F.nullif(F.regexp_extract(low, r"^q([1-4])", 1), F.lit("")),
            F.nullif(F.regexp_extract(low, r"^([1-4])q", 1), F.lit("")),
            *[F.when(low.startswith(w), str(k)) for k, w in enumerate(ORDINALS, 1)],
        )
        return F.when(number.isNull(), F.concat(F.lit("FY"), year)).otherwise(F.concat(F.lit("Q"), number, F.lit(" FY"), year))

    return F.transform(F.regexp_extract_all(text, F.lit(ANY_LABEL), F.lit(0)), label)
