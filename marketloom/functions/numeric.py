"""Scalar number helpers, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_missing(x) -> Column:
    """NULL or NaN."""
    return _col(x).isNull() | F.isnan(_col(x))


def zero_if_missing(x) -> Column:
    return F.when(is_missing(x), F.lit(0.0)).otherwise(_col(x))


def to_number(x) -> Column:
    """Value as a double; whatever is not a number becomes 0."""
    return zero_if_missing(_col(x).try_cast("double"))


def safe_int(x) -> Column:
    """Half-even rounding to a whole number; NULL, NaN and infinities give 0."""
    x = _col(x)
    finite = ~is_missing(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(finite, F.bround(x, 0)).otherwise(F.lit(0.0)).cast("bigint")


def round_even(x, places: int) -> Column:
    return F.bround(_col(x), places)


def pct_change(value, base) -> Column:
    """(value - base) / base * 100, and 0 where that has no value."""
    value, base = _col(value), _col(base)
    return zero_if_missing(F.try_divide(value - base, base) * 100)


def floor_at_zero(x) -> Column:
    x = _col(x)
    return F.greatest(F.lit(0).cast("bigint"), x)


def min_max_scale(x, low, high) -> Column:
    """Position of x between low and high; 0 where they coincide."""
    x, low, high = _col(x), _col(low), _col(high)
    return F.when(high == low, F.lit(0.0)).otherwise(F.try_divide(x - low, high - low))


def min_max_unscale(scaled, low, high) -> Column:
    scaled, low, high = _col(scaled), _col(low), _col(high)
    return scaled * (high - low) + low


def days_after(day, n) -> Column:
    """Calendar days, whatever gaps the series has."""
    return F.date_add(_col(day), n)
