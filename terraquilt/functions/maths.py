"""Numeric rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPSILON = 1e-10


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``; NaN and NULL pass through (``least`` alone would turn NaN into ``high``)."""
    return F.when(F.isnan(value), value).when(value < low, F.lit(float(low))).when(
        value > high, F.lit(float(high))
    ).otherwise(value)


def safe_ratio(top: Column, bottom: Column, epsilon: float = 0.0) -> Column:
    """Quotient that is NULL instead of an error when the divisor is zero."""
    return F.try_divide(top, bottom + F.lit(epsilon) if epsilon else bottom)


def mean_of_two(a: Column, b: Column) -> Column:
    return (a + b) / F.lit(2.0)


# Compass classes of the eight 45-degree sectors that start at 22.5 degrees,
# counter-clockwise from east; each sector includes its lower edge.
BEARING_SECTORS = ("NE-SW", "N-S", "NW-SE", "NE-SW", "E-W", "N-S", "NW-SE", "E-W")


def bearing_class(dx: Column, dy: Column) -> Column:
    """Compass class of a segment; NULL ends fall into E-W."""
    turned = F.pmod(F.degrees(F.atan2(dy, dx)) - F.lit(22.5), F.lit(360.0))
    sectors = F.array(*[F.lit(name) for name in BEARING_SECTORS])
    return F.coalesce(F.get(sectors, F.floor(turned / 45).cast("int")), F.lit("E-W"))


def quantise(value: Column, low: Column, high: Column, levels: int = 16) -> Column:
    """Level ``0 .. levels-1`` of a value within its band's range."""
    return F.floor((value - low) / (high - low + 1) * levels).cast("int")


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
