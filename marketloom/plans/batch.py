"""The full batch run: summary, forecasts, anomalies, stored results."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.text import json_record
from marketloom.operators.anomaly import (
    anomaly_daily,
    anomaly_features,
    anomaly_summary,
    anomaly_threshold,
    flag_anomalies,
    top_anomalies,
)
from marketloom.operators.baseline import baseline_forecast
from marketloom.operators.forecast import (
    backtest,
    forecast_from_predictions,
    ridge_predictions,
    series_meta,
)
from marketloom.operators.forest import FOREST_MODEL, Forest, fit_forest
from marketloom.operators.profile import dataset_info
from marketloom.operators.report import forecast_records
from marketloom.operators.series import (
    daily_series,
    history_tail,
    naive_backtest,
    spread_series,
    with_series_path,
)
from marketloom.schema import ANOMALY_RATE, N_TREES, RESULT_VERSION, SEED
from marketloom.scratch import scratch_folder, written
from marketloom.sources.panel import cached
from marketloom.sources.results import ResultStore


class AnomalyRun(NamedTuple):
    flagged: DataFrame
    forest: Forest | None
    threshold: float | None


def together(spark: SparkSession, *calls: Callable[[], object]) -> list:
    """Run the calls at the same time, so that their jobs share the cluster."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(calls)) as pool:
        started = [pool.submit(inherit(call)) for call in calls]
        return [one.result() for one in started]


def detect_anomalies(
    panel: DataFrame,
    rate: float = ANOMALY_RATE,
    n_trees: int = N_TREES,
    seed: int = SEED,
    keep: Callable[[DataFrame, str], DataFrame] = written,
    temp: Callable[[DataFrame, str], DataFrame] = written,
) -> AnomalyRun:
    """Features, forest, scores and flags of a panel.

    Features are written once by `temp` and scores by `keep`: sampling, quantile
    and reports then read only the columns they need from there. The features
    are not needed once the scores are there, which hold them too.
    """
    features = temp(anomaly_features(panel, compact=True), "features")
    forest = fit_forest(features, n_trees=n_trees, seed=seed)
    if forest is None:
        scored = keep(features.withColumn("score", F.lit(None).cast("double")), "scored")
        return AnomalyRun(flag_anomalies(scored, None), None, None)
    scored = keep(forest.score(features), "scored")
    threshold = anomaly_threshold(scored, rate)
    return AnomalyRun(flag_anomalies(scored, threshold), forest, threshold)


def forecast_results(
    daily: DataFrame, temp: Callable[[DataFrame, str], DataFrame] = written
) -> dict[str, DataFrame]:
    """Forecast tables of all series; each is routed once and each model series fitted once."""
    routed = temp(with_series_path(spread_series(daily)), "routed")
    modelled, short = (routed.where(F.col("path") == p).drop("path") for p in ("model", "baseline"))
    predictions = temp(ridge_predictions(modelled), "predictions")
    forecasts = forecast_from_predictions(predictions, modelled).unionByName(
        baseline_forecast(short)
    )
    naive = naive_backtest(short).select(
        "commodity",
        F.lit(1).alias("step"),
        F.col("obs_date").alias("origin_date"),
        "actual",
        "prediction",
    )
    columns = ["commodity", "step", "origin_date", "actual", "prediction"]
    return {
        "forecast": forecasts,
        "backtest": backtest(predictions).select(*columns).unionByName(naive),
        "history": history_tail(daily),
    }


def run_batch(
    panel: DataFrame, root: str, force: bool = False, version: int = RESULT_VERSION
) -> dict[str, DataFrame]:
    """All result tables by name, from the store if this version has them.

    `force` makes a new run in any case. Summary, forecasts and anomalies do
    not depend on each other and run side by side over the cached panel.
    """
    spark = panel.sparkSession
    store = ResultStore(spark, root, version)
    done = None if force else store.latest()
    if done:
        run, names = done
        return {name: store.read(run, name) for name in names}

    run = store.new_run()
    tables: dict[str, DataFrame] = {}

    def save(name: str, table: DataFrame) -> DataFrame:
        tables[name] = store.write(run, name, table)
        return tables[name]

    def save_all(made: dict[str, DataFrame]) -> None:
        together(spark, *[partial(save, name, table) for name, table in made.items()])

    def forecasts() -> None:
        save_all(forecast_results(temp(daily_series(rows), "daily"), temp))
        forecast = tables["forecast"]
        save_all(
            {
                "forecast_metrics": forecast.select("commodity", "step", "mae", "rmse", "mape"),
                "series_meta": series_meta(forecast),
                "forecast_records": forecast_records(
                    forecast, tables["backtest"], tables["history"]
                ),
            }
        )

    def anomalies() -> None:
        found = detect_anomalies(rows, keep=lambda table, name: save(name, table), temp=temp)
        made = {
            "threshold": spark.createDataFrame([(found.threshold,)], "threshold double"),
            "anomaly_summary": anomaly_summary(found.flagged, FOREST_MODEL),
            "top_anomalies": top_anomalies(found.flagged),
            "anomaly_daily": anomaly_daily(found.flagged),
        }
        if found.forest is not None:
            made["forest"] = found.forest.node_table(spark)
        save_all(made)

    with cached(panel) as rows, scratch_folder(spark, "batch") as temp:
        together(spark, lambda: save("dataset_info", dataset_info(rows)), forecasts, anomalies)
    store.finish(run, sorted(tables))
    return tables


def as_json(table: DataFrame) -> DataFrame:
    """Each row of a result table as one JSON object."""
    return table.select(json_record(*table.columns).alias("record"))
