"""The mechanical rubric as Column expressions: a value against a stated range."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-9


def slack(bound: Column) -> Column:
    """Room for binary floats at a bound; not a tolerance."""
    return F.lit(EPSILON) * F.greatest(F.abs(bound), F.lit(1.0))


def is_point(low: Column, high: Column) -> Column:
    return F.coalesce(low == high, F.lit(False))


def is_floor(low: Column, high: Column) -> Column:
    return low.isNotNull() & high.isNull()


def _above(high: Column, value: Column) -> Column:
    return F.coalesce(value > high + slack(high), F.lit(False))


def _below(low: Column, value: Column) -> Column:
    return F.coalesce(value < low - slack(low), F.lit(False))


def in_range(low: Column, high: Column, value: Column) -> Column:
    """Whether the value is inside, bounds included; null when there is nothing to compare."""
    return F.when(value.isNull() | (low.isNull() & high.isNull()), None).otherwise(~_below(low, value) & ~_above(high, value))


def side(low: Column, high: Column, value: Column) -> Column:
    return F.when(_above(high, value), "above").when(_below(low, value), "below")


def direction(low: Column, high: Column, value: Column, higher_is_better: Column) -> Column:
    """``better`` or ``worse`` for a value outside the range."""
    return F.when((side(low, high, value) == "above") == higher_is_better, "better").when(side(low, high, value).isNotNull() & higher_is_better.isNotNull(), "worse")


def withdrawn_before_close(withdrawn_at: Column, period_end: Column) -> Column:
    return F.coalesce(withdrawn_at <= period_end, F.lit(False))


def resolve(low: Column, high: Column, value: Column, reviewed: Column, period_closed: Column, withdrawn: Column) -> Column:
    """Status by precedence: open, withdrawn, unresolved, then met or missed."""
    inside = in_range(low, high, value)
    return F.when(~reviewed, "open").when(withdrawn, "withdrawn").when(~period_closed | inside.isNull(), "unresolved").when(inside, "met").otherwise("missed")


def days_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first).cast("long")


def nearest_edge(low: Column, high: Column, value: Column) -> Column:
    """The bound a value outside the range is measured against; a point is its own edge."""
    return F.when(is_point(low, high), low).when(side(low, high, value) == "above", high).when(side(low, high, value) == "below", low)


def miss_fraction(low: Column, high: Column, value: Column) -> Column:
    """Distance from the edge as a share of its size; null without an edge or at edge zero."""
    edge = nearest_edge(low, high, value)
    return F.when(edge != 0, F.abs(value - edge) / F.abs(edge))


def miss_magnitude(low: Column, high: Column, value: Column, status: Column) -> Column:
    """Signed distance over the signed edge, of missed rows."""
    edge = nearest_edge(low, high, value)
    return F.when((status == "missed") & (edge != 0), (value - edge) / edge)


def acknowledgement_bucket(status: Column, acknowledged_at: Column, days: Column) -> Column:
    return (
        F.when(status != "missed", None)
        .when(acknowledged_at.isNull(), "never acknowledged")
        .when(F.coalesce(days, F.lit(0)) == 0, "acknowledged in the same filing")
        .otherwise("acknowledged later")
    )
