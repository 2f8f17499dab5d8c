"""Errors of predictions against what came."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numeric import round_even


def metric_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs that count: both values known and the actual one not 0."""
    return pairs.where(_counts())


def _counts():
    actual, prediction = F.col("actual"), F.col("prediction")
    return actual.isNotNull() & prediction.isNotNull() & (actual != 0)


def error_aggregates() -> list[Column]:
    """MAE and RMSE in whole units and MAPE with two places.

    For use in `agg` over columns `actual` and `prediction`; without a pair
    that counts the errors are 0.
    """
    error = F.when(_counts(), F.col("actual") - F.col("prediction"))
    relative = F.abs(F.try_divide(error, F.col("actual"))) * 100

    def or_zero(column, places):
        return F.coalesce(round_even(column, places), F.lit(0.0))

    return [
        or_zero(F.avg(F.abs(error)), 0).alias("mae"),
        or_zero(F.sqrt(F.avg(error * error)), 0).alias("rmse"),
        or_zero(F.avg(relative), 2).alias("mape"),
    ]


def regression_metrics(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pairs.groupBy(*keys).agg(*error_aggregates())
