"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts.
Results go to Spark's no-op sink, so every row is computed and none collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketloom.operators import anomaly, baseline, forecast, forest, profile, series  # noqa: E402
from marketloom.plans import batch, catalog, panels  # noqa: E402
from marketloom.scratch import scratch_path, written  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def headline(spark: SparkSession) -> dict[str, Callable[[], object]]:
    """Queries by name, over the cached panel as a batch run has it."""
    panel = panels.panel(spark, SF_DIR)
    panel.count()
    daily = written(series.daily_series(panel), "daily")
    features = written(anomaly.anomaly_features(panel, compact=True), "features")
    fitted = forest.fit_forest(features)
    scored = written(fitted.score(features), "scored")

    def report() -> None:
        flagged = anomaly.flag_anomalies(scored, anomaly.anomaly_threshold(scored))
        consume(anomaly.anomaly_summary(flagged, forest.FOREST_MODEL))
        consume(anomaly.top_anomalies(flagged))
        consume(anomaly.anomaly_daily(flagged))

    return {
        "dataset_profile": lambda: consume(profile.dataset_info(panel)),
        "daily_series": lambda: consume(series.daily_series(panel)),
        "lag_features": lambda: consume(series.forecast_features(daily)),
        "baseline_forecast": lambda: consume(baseline.baseline_forecast(daily)),
        "model_forecast": lambda: consume(forecast.ridge_predictions(series.spread_series(daily))),
        "anomaly_features": lambda: consume(anomaly.anomaly_features(panel, compact=True)),
        "forest_fit": lambda: forest.fit_forest(features),
        "forest_score": lambda: consume(fitted.score(features)),
        "anomaly_report": report,
        "stream_daily_means": lambda: consume(catalog.stream_daily_means(spark, SF_DIR)),
        "full_batch": lambda: batch.run_batch(panel, scratch_path(spark, "bench")),
    }


def median_seconds(run: Callable[[], object]) -> float:
    run()
    took = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        took.append(time.perf_counter() - start)
    return round(statistics.median(took), 3)


def main() -> None:
    spark = session()
    # First of all, as it would be read from the cache later.
    build = median_seconds(lambda: consume(panels.price_rows(spark, SF_DIR)))
    seconds = {"panel_build": build}
    for name, run in headline(spark).items():
        seconds[name] = median_seconds(run)
    print(
        json.dumps(
            {
                "metric": "price panel headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
