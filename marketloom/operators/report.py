"""Nested records and display tables made from the result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numeric import safe_int
from marketloom.functions.text import (
    flag_text,
    iso_date_text,
    json_record,
    money_text,
    percent_text,
    severity,
    signed_percent_text,
)
from marketloom.operators.anomaly import anomaly_daily, anomaly_summary, top_anomalies
from marketloom.operators.skew import attach
from marketloom.schema import CRITICAL_SCORE, PAGE_ROWS


def metric_arrays(forecasts: DataFrame) -> DataFrame:
    """Headline errors (first step) and per-step errors in step order."""
    steps = F.sort_array(F.collect_list(F.struct("step", "mae", "rmse", "mape")))
    return (
        forecasts.groupBy("commodity")
        .agg(steps.alias("s"))
        .select(
            "commodity",
            F.col("s")[0]["mae"].alias("mae"),
            F.col("s")[0]["rmse"].alias("rmse"),
            F.col("s")[0]["mape"].alias("mape"),
            F.col("s.mae").alias("mae_by_step"),
            F.col("s.mape").alias("mape_by_step"),
        )
    )


def evaluation_chart(backtests: DataFrame) -> DataFrame:
    """First-step hold-out predictions in whole units."""
    return backtests.where(F.col("step") == 1).select(
        "commodity",
        "origin_date",
        safe_int("actual").alias("actual"),
        safe_int("prediction").alias("prediction"),
    )


def _by_date(rows: DataFrame, date: str, value: list[str], name: str) -> DataFrame:
    point = F.struct(iso_date_text(date).alias("date"), *value)
    return rows.groupBy("commodity").agg(F.sort_array(F.collect_list(point)).alias(name))


def forecast_records(
    forecasts: DataFrame, backtests: DataFrame, history: DataFrame
) -> DataFrame:
    """One JSON record per series: errors, back-test, history, forecast and sizes.

    A series' lists are bounded by the days of its hold-out part, 60 and 7.
    """
    ahead = _by_date(forecasts, "target_date", ["step", "price"], "forecast")
    tested = _by_date(
        evaluation_chart(backtests), "origin_date", ["actual", "prediction"], "backtest"
    )
    past = _by_date(history, "obs_date", [safe_int("price").alias("price")], "history")
    meta = forecasts.where(F.col("step") == 1).select(
        "commodity", "n_days", "n_samples", "model"
    )
    joined = metric_arrays(forecasts)
    for part in (meta, ahead, tested, past):
        joined = attach(joined, part, ["commodity"])
    fields = [c for c in joined.columns if c != "commodity"]
    return joined.select("commodity", json_record("commodity", *fields).alias("record"))


def forecast_table(forecasts: DataFrame) -> DataFrame:
    """Forecast rows as display text."""
    return forecasts.select(
        "commodity",
        "step",
        F.concat(F.lit("H+"), F.col("step").cast("string")).alias("step_text"),
        iso_date_text("target_date").alias("date_text"),
        money_text("price").alias("price_text"),
        money_text("mae").alias("mae_text"),
        percent_text("mape").alias("mape_text"),
    )


def anomaly_page(top: DataFrame, show_all: bool = False, rows: int = PAGE_ROWS) -> DataFrame:
    """The first page of the top list, or all of it."""
    ordered = top.orderBy("score", "obs_date", "region", "commodity", "price")
    return ordered if show_all else ordered.limit(rows)


def anomaly_table(top: DataFrame, critical: float = CRITICAL_SCORE) -> DataFrame:
    """Top list as display text."""
    return top.select(
        iso_date_text("obs_date").alias("date_text"),
        "region",
        "commodity",
        money_text("price").alias("price_text"),
        signed_percent_text("deviation_pct").alias("deviation_text"),
        signed_percent_text("delta_pct").alias("delta_text"),
        "rain_mm",
        flag_text("is_holiday").alias("holiday_text"),
        "score",
        severity("score", critical).alias("severity"),
    )


def anomaly_record(flagged: DataFrame, model: str) -> DataFrame:
    """The whole anomaly report as one JSON record: totals, top list, daily counts.

    The lists are bounded by the length of the top list and of the calendar.
    """
    top = F.struct(iso_date_text("obs_date").alias("date"), "region", "commodity", "price", "score")
    place = F.row_number().over(Window.orderBy("score", "obs_date", "region", "commodity", "price"))
    listed = top_anomalies(flagged).withColumn("place", place)
    day = F.struct(iso_date_text("obs_date").alias("date"), "n_anomalies")
    parts = (
        listed.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", top.alias("row")))), lambda x: x["row"]).alias("top")),
        anomaly_daily(flagged).agg(F.array_sort(F.collect_list(day)).alias("daily")),
    )
    whole = in_one_row(anomaly_summary(flagged, model), *parts)
    return whole.select(json_record(*whole.columns).alias("record"))


def in_one_row(*parts: DataFrame) -> DataFrame:
    """The columns of several one-row tables side by side."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns])
