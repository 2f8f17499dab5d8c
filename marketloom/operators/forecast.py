"""Seven-day forecast of every series in one job.

Long series get a ridge regression from the last 30 days of ten inputs to the
next seven prices; each series is fitted on its own by an executor. Short ones
get the moving average. Both end up in one table of predictions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numeric import days_after, floor_at_zero, safe_int
from marketloom.operators.baseline import baseline_forecast
from marketloom.operators.metrics import error_aggregates, regression_metrics
from marketloom.operators.ridge import backtest_and_forecast
from marketloom.operators.series import (
    fill_gaps,
    history_tail,
    series_size,
    spread_series,
    with_series_path,
)
from marketloom.operators.skew import attach
from marketloom.schema import (
    HORIZON,
    MODEL_INPUTS,
    PRICE,
    SEQUENCE_DAYS,
    SERIES_DAY,
    TEST_RATIO,
)

RIDGE_MODEL = "multivariate ridge regression"
PREDICTIONS = (
    "commodity string, kind string, step int, origin_date date, actual double, prediction double"
)


def ridge_predictions(
    daily: DataFrame,
    days: int = SEQUENCE_DAYS,
    horizon: int = HORIZON,
    test_ratio: float = TEST_RATIO,
    penalty: float = 1.0,
    purge: int = 0,
    inputs: Sequence[str] = MODEL_INPUTS,
) -> DataFrame:
    """Back-test and forecast of each series, in one fit per series.

    Rows of kind `test` carry the hold-out samples by the date of their first
    target; rows of kind `forecast` carry the steps after the last date.
    Scaling is learned from the rows before the first test target. `purge`
    leaves out that many samples before it, whose targets reach into the test.
    The first of `inputs` is what is forecast.
    Series are fitted side by side as far as `daily` is spread over tasks.
    """

    def fit_series(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("obs_date")
        dates = rows["obs_date"].to_numpy()
        values = rows[list(inputs)].to_numpy(dtype="float64")
        n_train, actual, tested, ahead = backtest_and_forecast(
            values, days, horizon, test_ratio, penalty, purge
        )
        steps = np.arange(1, horizon + 1, dtype="int32")
        origins = dates[days + n_train : days + n_train + len(tested)]
        test = pd.DataFrame(
            {
                "kind": "test",
                "step": np.tile(steps, len(tested)),
                "origin_date": np.repeat(origins, horizon),
                "actual": actual.ravel(),
                "prediction": tested.ravel(),
            }
        )
        forecast = pd.DataFrame(
            {
                "kind": "forecast",
                "step": steps,
                "origin_date": dates[-1],
                "actual": np.nan,
                "prediction": ahead,
            }
        )
        out = pd.concat([test, forecast])
        out.insert(0, "commodity", rows["commodity"].iloc[0])
        return out

    filled = fill_gaps(daily.select(*SERIES_DAY, *inputs), inputs)
    return filled.groupBy("commodity").applyInPandas(fit_series, PREDICTIONS)


def split_paths(daily: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(days of series for the model, days of series for the baseline)."""
    routed = with_series_path(spread_series(daily))
    return (
        routed.where(F.col("path") == "model").drop("path"),
        routed.where(F.col("path") == "baseline").drop("path"),
    )


def backtest(predictions: DataFrame) -> DataFrame:
    """Hold-out samples, one row per series, origin and step."""
    return predictions.where(F.col("kind") == "test").drop("kind")


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """Errors of each series at each step."""
    return regression_metrics(backtest(predictions), ["commodity", "step"])


def model_forecast(predictions: DataFrame) -> DataFrame:
    """Forecast rows with whole prices, never below 0."""
    return predictions.where(F.col("kind") == "forecast").select(
        "commodity",
        "step",
        days_after("origin_date", F.col("step")).alias("target_date"),
        floor_at_zero(safe_int("prediction")).alias("price"),
    )


def forecast_from_predictions(predictions: DataFrame, daily: DataFrame) -> DataFrame:
    """Forecast of the model path in the shape of the baseline's.

    Forecast and errors come from one grouping, so that unsaved predictions are
    made only once.
    """
    ahead = F.col("kind") == "forecast"
    per_step = (
        predictions.select(
            "commodity",
            "step",
            F.when(~ahead, F.col("actual")).alias("actual"),
            "prediction",
            F.when(ahead, F.col("prediction")).alias("next"),
            F.when(ahead, F.col("origin_date")).alias("last_date"),
        )
        .groupBy("commodity", "step")
        .agg(
            F.max("last_date").alias("last_date"),
            F.max("next").alias("next"),
            *error_aggregates(),
        )
    )
    return attach(per_step, series_size(daily), ["commodity"]).select(
        "commodity",
        "step",
        days_after("last_date", F.col("step")).alias("target_date"),
        floor_at_zero(safe_int("next")).alias("price"),
        "mae",
        "rmse",
        "mape",
        "n_days",
        "n_samples",
        F.lit(RIDGE_MODEL).alias("model"),
    )


def forecast_all(daily: DataFrame, predictions: DataFrame | None = None) -> DataFrame:
    """Forecast of every series: seven rows each, with errors and sizes.

    Pass `predictions` of the model path when they are stored already.
    """
    modelled, short = split_paths(daily)
    if predictions is None:
        predictions = ridge_predictions(modelled)
    return forecast_from_predictions(predictions, modelled).unionByName(
        baseline_forecast(short)
    )


def forecast_for(forecasts: DataFrame, commodity: str) -> DataFrame:
    """One series' forecast; no rows when there is no such series."""
    return forecasts.where(F.col("commodity") == commodity)


def series_meta(forecasts: DataFrame) -> DataFrame:
    return forecasts.where(F.col("step") == 1).select(
        "commodity", "n_days", "n_samples", "model"
    )


def forecast_chart(daily: DataFrame, forecasts: DataFrame) -> DataFrame:
    """History and forecast on one axis.

    The last history point appears in both parts, so that the lines meet.
    """
    history = history_tail(daily).select(
        "commodity",
        F.lit("history").alias("kind"),
        "obs_date",
        safe_int(PRICE).alias("price"),
    )
    bridge = (
        daily.groupBy("commodity")
        .agg(F.max("obs_date").alias("obs_date"), F.max_by(PRICE, "obs_date").alias("last"))
        .select(
            "commodity",
            F.lit("forecast").alias("kind"),
            "obs_date",
            safe_int("last").alias("price"),
        )
    )
    ahead = forecasts.select(
        "commodity",
        F.lit("forecast").alias("kind"),
        F.col("target_date").alias("obs_date"),
        "price",
    )
    return history.unionByName(bridge).unionByName(ahead)
