"""Numbers and ranges in words, as a review row prints them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNIFICANT = 6


def _short(digits: Column) -> Column:
    """Without the zeros that end a decimal fraction."""
    return F.regexp_replace(digits, r"\.?0+$", "")


def general(x: Column) -> Column:
    """Six significant digits without zeros at the end; powers of ten from a million up and below a ten-thousandth."""
    power = F.format_string(f"%.{SIGNIFICANT - 1}e", x)  # rounds first, so 999999.7 is a million
    mantissa, exponent = F.substring_index(power, "e", 1), F.substring_index(power, "e", -1)
    plain = _short(power.try_cast("decimal(38,12)").cast("string"))
    written = F.when(exponent.try_cast("int").between(-4, SIGNIFICANT - 1), plain).otherwise(F.concat(_short(mantissa), F.lit("e"), exponent))
    return F.when(x.isNull(), None).when(x == 0, "0").when(F.isnan(x) | (F.abs(x) == float("inf")), F.lower(x.cast("string"))).otherwise(written)


def amount(x: Column, unit: Column) -> Column:
    """A number with its unit: dollars by scale, dollars a share, percent, or the unit's name after it."""
    dollars = unit.isin("USD", "USD billions", "USD millions", "USD thousands", "USD per share")
    after = (
        F.when(unit == "USD", "")
        .when(unit == "USD billions", " billion")
        .when(unit == "USD millions", " million")
        .when(unit == "USD thousands", " thousand")
        .when(unit == "USD per share", " per share")
        .when(unit == "percent", "%")
        .otherwise(F.concat(F.lit(" "), unit))
    )
    return F.concat(F.when(dollars, "$").otherwise(""), F.when(unit == "USD", F.format_number(x, 2)).otherwise(general(x)), after)


def _bounds(low: Column, high: Column, point: str, both: str, floor: str, ceiling: str) -> tuple[Column, Column]:
    """The words before the first bound, and whether a second follows."""
    range_ = F.coalesce(low != high, F.lit(False))
    return F.when(low == high, point).when(range_, both).when(high.isNull(), floor).when(low.isNull(), ceiling), range_


def range_words(low: Column, high: Column, unit: Column) -> Column:
    """A point, a range, a floor or a ceiling in words; null without bounds."""
    before, range_ = _bounds(low, high, "", "", "at least ", "no more than ")
    return F.concat(before, amount(F.coalesce(low, high), unit), F.when(range_, F.concat(F.lit(" to "), amount(high, unit))).otherwise(""))


def claim(company: Column, metric: Column, low: Column, high: Column, unit: Column, period: Column) -> Column:
    """What a row says."""
    return F.concat(company, F.lit(" expects "), metric, F.lit(" of "), range_words(low, high, unit), F.lit(" for "), period, F.lit("."))


def invalidation(low: Column, high: Column) -> Column:
    """What would show a row to be wrong; null without bounds."""
    before, range_ = _bounds(low, high, "differs from ", "falls outside [", "is below ", "is above ")
    return F.concat(F.lit("reported value "), before, general(F.coalesce(low, high)), F.when(range_, F.concat(F.lit(", "), general(high), F.lit("]"))).otherwise(""))
