"""Moving-average forecast for short series, all series at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numeric import days_after, safe_int
from marketloom.operators.metrics import error_aggregates
from marketloom.operators.series import newest_first, whole_series
from marketloom.schema import AVERAGE_DAYS, BACKTEST_DAYS, HORIZON, PRICE

BASELINE_MODEL = "moving average of the last days"


def baseline_tail(
    daily: DataFrame, average_days: int = AVERAGE_DAYS, backtest_days: int = BACKTEST_DAYS
) -> DataFrame:
    """The last rows of each series with all that the baseline reads from them."""
    keep = max(average_days, backtest_days)
    return daily.select(
        "commodity",
        "obs_date",
        PRICE,
        F.lead(PRICE).over(newest_first()).alias("previous"),
        F.lead("obs_date").over(newest_first()).isNotNull().alias("has_previous"),
        F.row_number().over(newest_first()).alias("back"),
        F.count(F.lit(1)).over(whole_series()).alias("n_days"),
    ).where(F.col("back") <= keep)


def baseline_summary(
    daily: DataFrame, average_days: int = AVERAGE_DAYS, backtest_days: int = BACKTEST_DAYS
) -> DataFrame:
    """One row per series: forecast price, sizes and back-test errors."""
    tail = baseline_tail(daily, average_days, backtest_days)
    tested = (F.col("back") <= backtest_days) & F.col("has_previous")
    pairs = tail.select(
        "*",
        F.when(tested, F.col(PRICE)).alias("actual"),
        F.when(tested, F.col("previous")).alias("prediction"),
    )
    return pairs.groupBy("commodity").agg(
        F.max("obs_date").alias("last_date"),
        safe_int(F.avg(F.when(F.col("back") <= average_days, F.col(PRICE)))).alias("price"),
        F.max("n_days").alias("n_days"),
        F.sum(tested.cast("bigint")).alias("n_samples"),
        *error_aggregates(),
    )


def per_step(summary: DataFrame, horizon: int = HORIZON) -> DataFrame:
    return summary.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))


def baseline_forecast(
    daily: DataFrame,
    horizon: int = HORIZON,
    average_days: int = AVERAGE_DAYS,
    backtest_days: int = BACKTEST_DAYS,
) -> DataFrame:
    """One row per series and step, with the errors of the naive back-test.

    Target dates are calendar days after the last date of the series.
    """
    summary = baseline_summary(daily, average_days, backtest_days)
    return per_step(summary, horizon).select(
        "commodity",
        "step",
        days_after("last_date", F.col("step")).alias("target_date"),
        "price",
        "mae",
        "rmse",
        "mape",
        "n_days",
        "n_samples",
        F.lit(BASELINE_MODEL).alias("model"),
    )
