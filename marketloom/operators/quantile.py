"""Exact quantile of a column of any length."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BINS = 4096


def _count_in_bins(values: DataFrame, low: float, high: float) -> list:
    """Non-empty bins between two values, in order: weight, least and greatest value."""
    width = (high - low) / _BINS
    if width == 0 or math.isinf(width):  # only the lower end is told from the rest
        bin_no = F.when(F.col("v") == low, 0).otherwise(1)
    else:
        bin_no = F.least(F.floor((F.col("v") - low) / width), F.lit(_BINS - 1))
    bins = (
        values.where(F.col("v").between(low, high))
        .groupBy(bin_no.alias("bin"))
        .agg(F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()
    )
    return sorted(bins, key=lambda found: found["low"])


def exact_quantile(
    df: DataFrame, column: str, q: float, weight: str | Column | None = None
) -> float | None:
    """Linearly interpolated quantile, as in a sorted list; None without values.

    A row counts as often as its `weight` says. Each pass brings at most _BINS
    counts to the driver and goes on inside the one bin that holds the wanted
    rank, between the least and greatest value in it, until that is one value.
    """
    weight = F.lit(1) if weight is None else weight
    weight = F.col(weight) if isinstance(weight, str) else weight
    values = df.select(F.col(column).alias("v"), weight.cast("bigint").alias("w")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    whole = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("w").alias("n"))
    low, high, held = whole.first()
    if not held:
        return None
    place = q * (held - 1)
    rank = math.floor(place)
    below, after = 0, high
    while low < high:
        bins = _count_in_bins(values, low, high)
        for found, following in zip(bins, [*bins[1:], None]):
            if rank < below + found["n"]:
                break
            below += found["n"]
        low, high, held = found["low"], found["high"], found["n"]
        after = following["low"] if following else after
    right = low if rank + 1 < below + held else after
    return low + (right - low) * (place - rank)
