"""Every operator as a query over the given tables, with SQL to check it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import numeric, text
from marketloom.operators import (
    anomaly,
    baseline,
    forecast,
    forest,
    integrate,
    metrics,
    profile,
    report,
    series,
)
from marketloom.operators.block_ridge import ridge_in_blocks
from marketloom.operators.skew import expand_copies
from marketloom.plans import batch, panels
from marketloom.plans.oracle import over
from marketloom.plans.panels import keep, panel, short_panel, table
from marketloom.schema import (
    ANOMALY_FEATURES,
    CALENDAR,
    ENTITY,
    MODEL_INPUTS,
    PANEL_COLUMNS,
    PRICE,
    SERIES_DAY,
    SOURCE_HEADER,
    WEATHER,
)
from marketloom.scratch import scratch_path, written
from marketloom.sources import panel as files
from marketloom.streaming import alerts, feed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(make: Query) -> Query:
        QUERIES[name] = make
        if sql is not None:
            SQL[name] = sql
        return make

    return register


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def round_list(*columns: str, places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns)


def bigint(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


PANEL_LIST = ", ".join(PANEL_COLUMNS)


# Inputs shared by several queries.


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(spark, sf_dir, "daily", series.daily_series(panel(spark, sf_dir)))


def short_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(spark, sf_dir, "short_daily", series.daily_series(short_panel(spark, sf_dir)))


def short_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.baseline_forecast(short_daily(spark, sf_dir))


_made: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """A result made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        return written(anomaly.anomaly_features(panel(spark, sf_dir), compact=True), "features")

    return once(spark, sf_dir, "features", make)


def fitted_forest(spark: SparkSession, sf_dir: str) -> forest.Forest:
    return once(spark, sf_dir, "forest", lambda: forest.fit_forest(features(spark, sf_dir)))


def forest_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        return written(fitted_forest(spark, sf_dir).score(features(spark, sf_dir)), "scored")

    return once(spark, sf_dir, "forest_scored", make)


def forest_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forest_scored(spark, sf_dir)
    return once(
        spark,
        sf_dir,
        "forest_flagged",
        lambda: anomaly.flag_anomalies(scored, anomaly.anomaly_threshold(scored)),
    )


def plain_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score that SQL can compute too, in place of the forest's."""
    score = -F.abs("deviation_pct") - F.abs("delta_pct")
    return features(spark, sf_dir).withColumn("score", score)


def plain_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = plain_scored(spark, sf_dir)
    return anomaly.flag_anomalies(scored, anomaly.anomaly_threshold(scored))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make():
        days = series.spread_series(daily(spark, sf_dir))
        return written(forecast.ridge_predictions(days), "predictions")

    return once(spark, sf_dir, "predictions", make)


def both_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).unionByName(short_daily(spark, sf_dir))


# Sources and sinks.


@query("s01_csv_scan", over("panel", f" SELECT {PANEL_LIST} FROM panel"))
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "panel-csv")
    files.write_csv(panel(spark, sf_dir), path)
    return files.load_csv(spark, path)


@query(
    "s02_schema_enforcement",
    over(
        "panel",
        f""" SELECT {", ".join(c for c in PANEL_COLUMNS if c not in (PRICE, "is_holiday"))},
          CASE WHEN is_weekend = 0 THEN price END AS price,
          CASE WHEN region_id <> 3 THEN is_holiday END AS is_holiday FROM panel""",
    ),
)
def schema_enforcement(spark, sf_dir):
    """Cells that are no numbers come back as NULL in rows that stay."""
    path = scratch_path(spark, "panel-csv")
    broken = panel(spark, sf_dir).withColumns(
        {
            PRICE: F.when(F.col("is_weekend") == 0, F.col(PRICE).cast("string")).otherwise("n/a"),
            "is_holiday": F.when(
                F.col("region_id") != 3, F.col("is_holiday").cast("string")
            ).otherwise("no"),
        }
    )
    files.write_csv(broken, path)
    return files.scan_csv(spark, path)


@query(
    "s03_price_gate",
    over("short", f" SELECT {PANEL_LIST} FROM short WHERE price <> 0 AND price < 60"),
)
def price_gate(spark, sf_dir):
    price = F.col(PRICE)
    gaps = F.when(price >= 60, F.lit(float("nan"))).when(price != 0, price)
    return integrate.valid_rows(short_panel(spark, sf_dir).withColumn(PRICE, gaps))


@query("s05_stored_results", over("baseline", " SELECT * FROM baseline"))
def stored_results(spark, sf_dir):
    """The forecast table of a batch run, read back by a second one."""
    root = scratch_path(spark, "results")
    batch.run_batch(short_panel(spark, sf_dir), root)
    return batch.run_batch(short_panel(spark, sf_dir), root)["forecast"]


@query("s06_history_store", over("panel", f" SELECT {PANEL_LIST} FROM panel"))
def history_store(spark, sf_dir):
    path = scratch_path(spark, "history")
    files.write_history(panel(spark, sf_dir), path)
    return files.read_history(spark, path)


@query(
    "s06_history_range",
    over(
        "panel",
        f" SELECT {PANEL_LIST} FROM panel"
        " WHERE obs_date BETWEEN date '1997-03-10' AND date '1998-02-20'",
    ),
)
def history_range(spark, sf_dir):
    path = scratch_path(spark, "history")
    files.write_history(panel(spark, sf_dir), path)
    return files.read_history(spark, path, "1997-03-10", "1998-02-20")


# Projections, filters, predicates.


@query("p01_commodity_filter", over("panel", f" SELECT {PANEL_LIST} FROM panel WHERE commodity = 'LARGE'"))
def commodity_filter(spark, sf_dir):
    return panel(spark, sf_dir).where(F.col("commodity") == "LARGE")


@query(
    "p02_column_select",
    over("panel", " SELECT obs_date, region, commodity, price, rain_mm, is_holiday FROM panel"),
)
def column_select(spark, sf_dir):
    names = ["obs_date", "region", "commodity", PRICE, "rain_mm", PRICE, "is_holiday", "rain_mm"]
    return integrate.select_distinct_columns(panel(spark, sf_dir), names)


@query(
    "p03_derived_columns",
    over(
        "anomaly",
        f""" SELECT obs_date, region, commodity, previous_price,
          {round_list("province_mean", "deviation_pct", "delta_pct")} FROM anomaly""",
    ),
)
def derived_columns(spark, sf_dir):
    rows = anomaly.anomaly_rows(panel(spark, sf_dir)).select(
        "obs_date", *ENTITY, "previous_price", "province_mean", "deviation_pct", "delta_pct"
    )
    return rounded(rows, "province_mean", "deviation_pct", "delta_pct")


@query(
    "p04_rename",
    over(
        "panel",
        " SELECT "
        + ", ".join(f"{new} AS {old}" for old, new in zip(SOURCE_HEADER, PANEL_COLUMNS))
        + " FROM panel",
    ),
)
def rename(spark, sf_dir):
    return files.to_source_names(panel(spark, sf_dir))


@query("p05_commodity_list", over("panel", " SELECT DISTINCT commodity FROM panel"))
def commodity_list(spark, sf_dir):
    return profile.commodity_list(panel(spark, sf_dir))


@query("p06_forecast_lookup", over("baseline", " SELECT * FROM baseline WHERE commodity = 'click'"))
def forecast_lookup(spark, sf_dir):
    return forecast.forecast_for(short_forecast(spark, sf_dir), "click")


@query(
    "p07_anomalous_rows",
    over("flagged", " SELECT obs_date, region, commodity, price FROM flagged WHERE is_anom = 1"),
)
def anomalous_rows(spark, sf_dir):
    rows = anomaly.anomalous_rows(plain_flagged(spark, sf_dir))
    return rows.select("obs_date", *ENTITY, PRICE)


@query(
    "p08_metric_pairs",
    over(
        "short_anomaly",
        """ SELECT obs_date, region, commodity, price AS actual, previous_price AS prediction
        FROM short_anomaly WHERE price <> 0 AND previous_price IS NOT NULL""",
    ),
)
def metric_pairs(spark, sf_dir):
    rows = anomaly.with_previous_price(short_panel(spark, sf_dir)).select(
        "obs_date",
        *ENTITY,
        F.col(PRICE).alias("actual"),
        F.col("previous_price").alias("prediction"),
    )
    return metrics.metric_pairs(rows)


@query(
    "p09_severity",
    over(
        "scored",
        """ SELECT obs_date, region, commodity,
          CASE WHEN score < -100 THEN 'critical' ELSE 'normal' END AS severity FROM scored""",
    ),
)
def severity(spark, sf_dir):
    return plain_scored(spark, sf_dir).select(
        "obs_date", *ENTITY, text.severity("score", -100.0).alias("severity")
    )


@query(
    "p10_mape_band",
    over(
        "baseline",
        """ SELECT commodity, step, CASE WHEN mape < 10 THEN 'accurate' WHEN mape <= 20 THEN 'fair'
          ELSE 'poor' END AS band FROM baseline""",
    ),
)
def mape_band(spark, sf_dir):
    return short_forecast(spark, sf_dir).select(
        "commodity", "step", text.accuracy_band("mape").alias("band")
    )


# Joins.

_WEATHER_SQL = ", ".join(f"max({c}) AS {c}" for c in WEATHER)


@query(
    "j01_weather_integration",
    over(
        "prices",
        f""", weather AS (SELECT obs_date, region, {_WEATHER_SQL} FROM prices
          WHERE commodity <> 'SMALL' GROUP BY 1, 2)
        SELECT obs_date, region, commodity, price, {", ".join("w." + c for c in WEATHER)}
        FROM prices p LEFT JOIN weather w USING (obs_date, region)""",
    ),
)
def weather_integration(spark, sf_dir):
    rows = panels.price_parts(spark, sf_dir)
    weather = (
        rows.where(F.col("commodity") != "SMALL")
        .groupBy("obs_date", "region")
        .agg(*[F.max(c).alias(c) for c in WEATHER])
    )
    prices = rows.select("obs_date", *ENTITY, PRICE)
    return integrate.with_weather(prices, weather)


@query("j02_calendar_integration", over("panel", f" SELECT {PANEL_LIST} FROM panel"))
def calendar_integration(spark, sf_dir):
    prices = panels.price_parts(spark, sf_dir)
    return integrate.with_calendar(prices, panels.calendar(spark, sf_dir)).select(*PANEL_COLUMNS)


@query(
    "j03_province_mean",
    over(
        "anomaly",
        f" SELECT obs_date, region, commodity, price, {round_list('province_mean')} FROM anomaly",
    ),
)
def province_mean(spark, sf_dir):
    rows = anomaly.with_province_mean(panel(spark, sf_dir))
    return rounded(
        rows.select("obs_date", *ENTITY, PRICE, "province_mean"), "province_mean"
    )


_CHART_SQL = """,
    history AS (SELECT commodity, obs_date, cast(round_even(price, 0) AS bigint) AS price,
        row_number() OVER (PARTITION BY commodity ORDER BY obs_date DESC) AS back
      FROM short_daily),
    chart AS (
      SELECT commodity, 'history' AS kind, obs_date, price FROM history WHERE back <= 60
      UNION ALL SELECT commodity, 'forecast', obs_date, price FROM history WHERE back = 1
      UNION ALL SELECT commodity, 'forecast', target_date, price FROM baseline)
    SELECT * FROM chart"""


@query("j04_history_forecast_stitch", over("baseline", _CHART_SQL))
@query("u01_history_forecast_union", over("baseline", _CHART_SQL))
def history_forecast(spark, sf_dir):
    return forecast.forecast_chart(short_daily(spark, sf_dir), short_forecast(spark, sf_dir))


# Aggregations.


@query(
    "a01_dataset_info",
    over(
        "panel",
        """ SELECT count(*) AS total_rows, count(DISTINCT region) AS total_regions,
          count(DISTINCT commodity) AS total_commodities,
          string_agg(DISTINCT commodity, '|' ORDER BY commodity) AS commodities,
          min(obs_date) AS first_date, max(obs_date) AS last_date FROM panel""",
    ),
)
def dataset_info(spark, sf_dir):
    info = profile.dataset_info(panel(spark, sf_dir))
    return info.withColumn("commodities", F.array_join("commodities", "|"))


@query("a02_row_count", over("panel", " SELECT count(*) AS total_rows FROM panel"))
def row_count(spark, sf_dir):
    return profile.row_count(panel(spark, sf_dir))


@query(
    "a03_distinct_counts",
    over(
        "panel",
        """ SELECT count(DISTINCT region) AS total_regions,
          count(DISTINCT commodity) AS total_commodities FROM panel""",
    ),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(panel(spark, sf_dir))


@query(
    "a04_date_range",
    over("panel", " SELECT min(obs_date) AS first_date, max(obs_date) AS last_date FROM panel"),
)
def date_range(spark, sf_dir):
    return profile.date_range(panel(spark, sf_dir))


_DAILY_MEANS = [PRICE, *WEATHER]


@query(
    "a05_daily_series",
    over(
        "daily",
        f""" SELECT commodity, obs_date, {round_list(*_DAILY_MEANS)}, {", ".join(CALENDAR)}
        FROM daily""",
    ),
)
def daily_series(spark, sf_dir):
    return rounded(series.daily_series(panel(spark, sf_dir)), *_DAILY_MEANS)


@query(
    "a06_means",
    over(
        "panel",
        """ SELECT commodity, obs_date, round(avg(price), 6) AS price,
          round(avg(CASE WHEN region_id % 3 <> 0 THEN temp_avg_c END), 6) AS temp_avg_c,
          round(avg(CASE WHEN rain_mm >= 5 THEN rain_mm END), 6) AS rain_mm,
          round(avg(CASE WHEN is_weekend = 0 THEN humidity_avg_pct END), 6) AS humidity_avg_pct
        FROM panel GROUP BY 1, 2""",
    ),
)
def means_with_gaps(spark, sf_dir):
    """Missing cells count neither up nor down; a day without any has no mean."""
    gaps = {
        "temp_avg_c": F.when(F.col("region_id") % 3 != 0, F.col("temp_avg_c")),
        "rain_mm": F.when(F.col("rain_mm") >= 5, F.col("rain_mm")),
        "humidity_avg_pct": F.when(F.col("is_weekend") == 0, F.col("humidity_avg_pct")),
    }
    days = series.daily_series(panel(spark, sf_dir).withColumns(gaps))
    return rounded(days.select(*SERIES_DAY, *_DAILY_MEANS), *_DAILY_MEANS)


@query(
    "a07_calendar_per_day",
    over("short_daily", f" SELECT commodity, obs_date, {', '.join(CALENDAR)} FROM short_daily"),
)
def calendar_per_day(spark, sf_dir):
    return series.daily_series(short_panel(spark, sf_dir)).select(*SERIES_DAY, *CALENDAR)


def _naive_errors(spark, sf_dir):
    pairs = series.naive_backtest(short_daily(spark, sf_dir))
    return metrics.regression_metrics(pairs, ["commodity"])


@query("a08_mae", over("errors", " SELECT commodity, mae FROM errors"))
def mae(spark, sf_dir):
    return _naive_errors(spark, sf_dir).select("commodity", "mae")


@query("a09_rmse", over("errors", " SELECT commodity, rmse FROM errors"))
def rmse(spark, sf_dir):
    return _naive_errors(spark, sf_dir).select("commodity", "rmse")


@query("a10_mape", over("errors", " SELECT commodity, mape FROM errors"))
def mape(spark, sf_dir):
    return _naive_errors(spark, sf_dir).select("commodity", "mape")


@query(
    "a11_errors_per_step",
    over(
        "daily",
        """, ahead AS (SELECT commodity, cast(step AS int) AS step, price AS p,
            CASE step """
        + " ".join(
            f"WHEN {h} THEN lead(price, {h}) OVER (PARTITION BY commodity, step ORDER BY obs_date)"
            for h in range(1, 8)
        )
        + """ END AS a FROM daily CROSS JOIN range(1, 8) AS steps(step))
        SELECT commodity, step,
          coalesce(round_even(avg(abs(a - p)), 0), 0) AS mae,
          coalesce(round_even(sqrt(avg((a - p) * (a - p))), 0), 0) AS rmse,
          coalesce(round_even(avg(abs((a - p) / a) * 100), 2), 0) AS mape
        FROM ahead WHERE a IS NOT NULL GROUP BY 1, 2""",
    ),
)
def errors_per_step(spark, sf_dir):
    """Each day's price as the prediction of the next seven."""
    ahead = daily(spark, sf_dir).withColumns(series.lead_labels())
    steps = [
        F.struct(F.lit(h).alias("step"), F.col(f"label_h{h}").alias("actual"))
        for h in range(1, 8)
    ]
    pairs = ahead.select(
        "commodity", F.col(PRICE).alias("prediction"), F.inline(F.array(*steps))
    )
    return metrics.regression_metrics(pairs, ["commodity", "step"])


@query("a11_model_errors_per_step")
def model_errors_per_step(spark, sf_dir):
    return forecast.forecast_metrics(predictions(spark, sf_dir))


@query(
    "a12_daily_counts",
    over(
        "flagged",
        """ SELECT obs_date, cast(sum(is_anom) AS bigint) AS n_anomalies
        FROM flagged GROUP BY 1""",
    ),
)
def daily_counts(spark, sf_dir):
    return anomaly.anomaly_daily(plain_flagged(spark, sf_dir))


@query(
    "a13_anomaly_totals",
    over(
        "flagged",
        """ SELECT cast(sum(is_anom) AS bigint) AS total_anomalies, count(*) AS total_rows,
          round_even(sum(is_anom) / count(*) * 100, 2) AS pct_anomalies, 'plain score' AS model
        FROM flagged""",
    ),
)
def anomaly_totals(spark, sf_dir):
    return anomaly.anomaly_summary(plain_flagged(spark, sf_dir), "plain score")


@query(
    "a14_contamination_quantile",
    over("scored", " SELECT round(quantile_cont(score, 0.03), 6) AS threshold FROM scored"),
)
def contamination_quantile(spark, sf_dir):
    threshold = anomaly.anomaly_threshold(plain_scored(spark, sf_dir))
    return rounded(spark.createDataFrame([(threshold,)], "threshold double"), "threshold")


_ENDS = [f"{c}_{end}" for c in MODEL_INPUTS for end in ("min", "max")]


@query(
    "a15_scaling_statistics",
    over(
        "daily",
        ", numbered AS (SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY obs_date)"
        " AS n, count(*) OVER (PARTITION BY commodity) AS n_days FROM daily) SELECT commodity, "
        + ", ".join(
            f"round({end}({c}), 6) AS {c}_{end}" if c in _DAILY_MEANS else f"{end}({c}) AS {c}_{end}"
            for c in MODEL_INPUTS
            for end in ("min", "max")
        )
        + """ FROM numbered
        WHERE n <= 30 + greatest(1, least(floor((n_days - 36) * 0.8), n_days - 37))
        GROUP BY 1""",
    ),
)
def scaling_statistics(spark, sf_dir):
    ends = series.scaling_statistics(series.train_rows(daily(spark, sf_dir)))
    return rounded(ends, *[f"{c}_{end}" for c in _DAILY_MEANS for end in ("min", "max")])


def _feature_sql(c: str) -> str:
    return f"cast(coalesce({c}, 0) AS double)"


@query(
    "a16_standardisation_statistics",
    over(
        "anomaly",
        " "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({_feature_sql(c)}), 6) AS mean,"
            f" round(stddev_pop({_feature_sql(c)}), 6) AS std FROM anomaly"
            for c in ANOMALY_FEATURES
        ),
    ),
)
def standardisation_statistics(spark, sf_dir):
    rows = anomaly.anomaly_features(panel(spark, sf_dir))
    return rounded(anomaly.standardisation_statistics(rows), "mean", "std")


@query(
    "a17_series_size",
    over(
        "daily short_daily",
        """ SELECT commodity, count(*) AS n_days, greatest(count(*) - 36, 0) AS n_samples
        FROM (FROM daily UNION ALL FROM short_daily) GROUP BY 1""",
    ),
)
def series_size(spark, sf_dir):
    return series.series_size(both_daily(spark, sf_dir))


# Window functions.

_BY_DAY = "(PARTITION BY commodity ORDER BY obs_date)"


def _window_query(name: str, columns: Callable[[], dict], sql: dict[str, str], exact=()):
    inexact = [c for c in sql if c not in exact]

    @query(
        name,
        over(
            "daily",
            " SELECT commodity, obs_date, "
            + ", ".join(
                f"{e} AS {c}" if c in exact else f"round({e}, 6) AS {c}" for c, e in sql.items()
            )
            + " FROM daily",
        ),
    )
    def run(spark, sf_dir):
        made = columns()
        rows = daily(spark, sf_dir).select(*SERIES_DAY, *[e.alias(c) for c, e in made.items()])
        return rounded(rows, *inexact)

    return run


_LAGS = {f"lag_{k}": f"lag(price, {k}) OVER {_BY_DAY}" for k in (1, 7, 14, 30)}
_LEADS = {f"label_h{h}": f"lead(price, {h}) OVER {_BY_DAY}" for h in range(1, 8)}
_TRENDS = {f"trend_{k}": f"price - lag(price, {k}) OVER {_BY_DAY}" for k in (1, 7)}
_ROLLING = {
    f"rolling_{n}": "avg(price) OVER (PARTITION BY commodity ORDER BY obs_date"
    f" ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    for n in (7, 30)
}
_ROW_NUM = {"row_num": f"row_number() OVER {_BY_DAY}"}

_window_query("w01_lags", series.price_lags, _LAGS)
_window_query(
    "w02_rolling_7", lambda: series.rolling_means([7]), {"rolling_7": _ROLLING["rolling_7"]}
)
_window_query(
    "w03_rolling_30", lambda: series.rolling_means([30]), {"rolling_30": _ROLLING["rolling_30"]}
)
_window_query("w04_trends", series.price_trends, _TRENDS)
_window_query("w05_row_number", series.row_numbers, _ROW_NUM, exact=["row_num"])
_window_query("w06_lead_labels", series.lead_labels, _LEADS)

_FEATURES = {**_LAGS, **_ROLLING, **_TRENDS, **_LEADS}


@query(
    "w07_forecast_features",
    over(
        "daily",
        f" SELECT commodity, obs_date, row_number() OVER {_BY_DAY} AS row_num, "
        + ", ".join(f"round({e}, 6) AS {c}" for c, e in _FEATURES.items())
        + " FROM daily",
    ),
)
def forecast_features(spark, sf_dir):
    rows = series.forecast_features(daily(spark, sf_dir))
    return rounded(rows.select(*SERIES_DAY, "row_num", *_FEATURES), *_FEATURES)


@query(
    "w08_province_mean",
    over(
        "short_anomaly",
        f" SELECT obs_date, region, commodity, {round_list('province_mean')} FROM short_anomaly",
    ),
)
def short_province_mean(spark, sf_dir):
    rows = anomaly.with_province_mean(short_panel(spark, sf_dir))
    return rounded(rows.select("obs_date", *ENTITY, "province_mean"), "province_mean")


@query(
    "w09_deviation",
    over(
        "short_anomaly",
        f" SELECT obs_date, region, commodity, {round_list('deviation_pct')} FROM short_anomaly",
    ),
)
def deviation(spark, sf_dir):
    rows = anomaly.anomaly_rows(short_panel(spark, sf_dir))
    return rounded(rows.select("obs_date", *ENTITY, "deviation_pct"), "deviation_pct")


@query(
    "w10_entity_lag",
    over("anomaly", " SELECT obs_date, region, commodity, price, previous_price FROM anomaly"),
)
def entity_lag(spark, sf_dir):
    rows = anomaly.with_previous_price(panel(spark, sf_dir))
    return rows.select("obs_date", *ENTITY, PRICE, "previous_price")


@query(
    "w11_day_change",
    over(
        "short_anomaly",
        f" SELECT obs_date, region, commodity, {round_list('delta_pct')} FROM short_anomaly",
    ),
)
def day_change(spark, sf_dir):
    rows = anomaly.anomaly_rows(short_panel(spark, sf_dir))
    return rounded(rows.select("obs_date", *ENTITY, "delta_pct"), "delta_pct")


@query(
    "w12_input_sequences",
    over(
        "daily",
        f""" SELECT commodity, obs_date, cast(30 AS bigint) AS n, round(first_price, 6) AS first_price,
          last_eid FROM (SELECT commodity, obs_date, lag(price, 30) OVER {_BY_DAY} AS first_price,
            lag(days_to_eid) OVER {_BY_DAY} AS last_eid, row_number() OVER {_BY_DAY} AS k FROM daily)
        WHERE k > 30""",
    ),
)
def input_sequences(spark, sf_dir):
    rows = series.input_sequences(daily(spark, sf_dir)).select(
        *SERIES_DAY,
        F.size("inputs").cast("bigint").alias("n"),
        F.col("inputs")[0][PRICE].alias("first_price"),
        F.element_at("inputs", -1)["days_to_eid"].alias("last_eid"),
    )
    return rounded(rows, "first_price")


@query(
    "w13_target_vectors",
    over(
        "daily",
        f""" SELECT commodity, obs_date, cast(7 AS bigint) AS n, round(price, 6) AS first_price,
          round(last_price, 6) AS last_price
        FROM (SELECT commodity, obs_date, price, lead(price, 6) OVER {_BY_DAY} AS last_price,
          row_number() OVER {_BY_DAY} AS k FROM daily) WHERE k > 30 AND last_price IS NOT NULL""",
    ),
)
def target_vectors(spark, sf_dir):
    rows = series.target_vectors(daily(spark, sf_dir)).select(
        *SERIES_DAY,
        F.size("targets").cast("bigint").alias("n"),
        F.col("targets")[0].alias("first_price"),
        F.element_at("targets", -1).alias("last_price"),
    )
    return rounded(rows, "first_price", "last_price")


@query(
    "w14_naive_backtest",
    over(
        "backtest",
        f" SELECT commodity, obs_date, {round_list('actual', 'prediction')} FROM backtest",
    ),
)
def naive_backtest(spark, sf_dir):
    return rounded(series.naive_backtest(short_daily(spark, sf_dir)), "actual", "prediction")


@query(
    "w15_moving_average",
    over(
        "daily",
        """ SELECT commodity, round(avg(price), 6) AS mean_price FROM (SELECT *,
          row_number() OVER (PARTITION BY commodity ORDER BY obs_date DESC) AS back FROM daily)
        WHERE back <= 7 GROUP BY 1""",
    ),
)
def moving_average(spark, sf_dir):
    return rounded(series.moving_average(daily(spark, sf_dir)), "mean_price")


_RAIN = "CASE WHEN is_weekend = 1 OR month < 3 THEN NULL ELSE rain_mm END"


@query(
    "w16_fill_gaps",
    over(
        "daily",
        f""", gaps AS (SELECT commodity, obs_date, {_RAIN} AS rain_mm FROM daily)
        SELECT commodity, obs_date, round(coalesce(
          last_value(rain_mm IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY obs_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value(rain_mm IGNORE NULLS) OVER (PARTITION BY commodity ORDER BY obs_date
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS rain_mm FROM gaps""",
    ),
)
def fill_gaps(spark, sf_dir):
    gaps = daily(spark, sf_dir).select(*SERIES_DAY, F.expr(_RAIN).alias("rain_mm"))
    return rounded(series.fill_gaps(gaps, ["rain_mm"]), "rain_mm")


@query(
    "w17_chronological_split",
    over(
        "daily",
        """ SELECT commodity, obs_date, sample, CASE WHEN sample <= greatest(1,
            least(floor(n_samples * 0.8), n_samples - 1)) THEN 'train' ELSE 'test' END AS part
        FROM (SELECT commodity, obs_date, row_number() OVER (PARTITION BY commodity
            ORDER BY obs_date) - 30 AS sample,
            count(*) OVER (PARTITION BY commodity) - 36 AS n_samples FROM daily)
        WHERE sample BETWEEN 1 AND n_samples""",
    ),
)
def chronological_split(spark, sf_dir):
    return series.chronological_split(daily(spark, sf_dir))


# Sorts, limits, top-k.


@query(
    "t01_sorted_series",
    over("daily", " SELECT commodity, obs_date, round(price, 6) AS price FROM daily"),
)
def sorted_series(spark, sf_dir):
    rows = daily(spark, sf_dir).select(*SERIES_DAY, PRICE)
    return rounded(rows.orderBy("commodity", "obs_date"), PRICE)


@query("t02_sorted_list", over("short", " SELECT DISTINCT commodity FROM short"))
def sorted_list(spark, sf_dir):
    return profile.commodity_list(short_panel(spark, sf_dir))


_TOP_SQL = """ SELECT obs_date, region, commodity, cast(price AS bigint) AS price,
      round_even(deviation_pct, 1) AS deviation_pct, round_even(delta_pct, 1) AS delta_pct,
      round_even(rain_mm, 1) AS rain_mm, is_holiday, round_even(score, 4) AS score
    FROM (SELECT * FROM flagged WHERE is_anom = 1
      ORDER BY score, obs_date, region, commodity, price LIMIT {n})"""


@query("t03_top_anomalies", over("flagged", _TOP_SQL.format(n=50)))
def top_anomalies(spark, sf_dir):
    return anomaly.top_anomalies(plain_flagged(spark, sf_dir))


@query(
    "t04_history_tail",
    over(
        "daily",
        """ SELECT commodity, obs_date, round(price, 6) AS price FROM (SELECT *, row_number()
          OVER (PARTITION BY commodity ORDER BY obs_date DESC) AS back FROM daily)
        WHERE back <= 60""",
    ),
)
def history_tail(spark, sf_dir):
    return rounded(series.history_tail(daily(spark, sf_dir)), PRICE)


@query("t05_anomaly_page", over("flagged", _TOP_SQL.format(n=10)))
def anomaly_page(spark, sf_dir):
    return report.anomaly_page(anomaly.top_anomalies(plain_flagged(spark, sf_dir)))


@query(
    "t06_last_values",
    over(
        "daily",
        """ SELECT commodity, max(obs_date) AS last_date,
          round(max_by(price, obs_date), 6) AS last_price FROM daily GROUP BY 1""",
    ),
)
def last_values(spark, sf_dir):
    return rounded(series.last_values(daily(spark, sf_dir)), "last_price")


# Set operations: see also u01 above.


@query(
    "u02_all_series",
    over("baseline", " SELECT commodity, step, target_date, price, model FROM baseline"),
)
def all_series(spark, sf_dir):
    rows = forecast.forecast_all(short_daily(spark, sf_dir))
    return rows.select("commodity", "step", "target_date", "price", "model")


# Scalar functions.


@query(
    "f01_zero_fill",
    over(
        "short_anomaly",
        """ SELECT obs_date, region, commodity, coalesce(previous_price, 0) AS previous_price
        FROM short_anomaly""",
    ),
)
def zero_fill(spark, sf_dir):
    rows = anomaly.with_previous_price(short_panel(spark, sf_dir))
    return rows.select(
        "obs_date", *ENTITY, numeric.zero_if_missing("previous_price").alias("previous_price")
    )


_MIXED = "CASE WHEN l_returnflag = 'N' THEN cast(cast(l_quantity AS int) AS {}) ELSE l_returnflag END"


@query(
    "f02_numeric_coercion",
    f"""SELECT l_orderkey, l_linenumber,
      coalesce(try_cast({_MIXED.format("varchar")} AS double), 0) AS number FROM lineitem""",
)
def numeric_coercion(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numeric.to_number(F.expr(_MIXED.format("string"))).alias("number"),
    )


_GAPPY = """CASE WHEN event_type = 'click' THEN NULL WHEN event_type = 'error' THEN {nan}
    ELSE value END"""


@query(
    "f03_safe_int",
    f"""SELECT event_id, cast(CASE WHEN isfinite(x) THEN round_even(x, 0) ELSE 0 END AS bigint)
      AS whole FROM (SELECT event_id, {_GAPPY.format(nan="'NaN'::double")} AS x FROM events)""",
)
def safe_int(spark, sf_dir):
    value = F.expr(_GAPPY.format(nan="double('NaN')"))
    return table(spark, sf_dir, "events").select("event_id", numeric.safe_int(value).alias("whole"))


@query(
    "f04_round_even",
    """SELECT event_id, round_even(floor(value) / 2, 0) AS tie0, round_even(floor(value) / 8, 2) AS tie2,
      round_even(sqrt(value), 0) AS r0, round_even(sqrt(value), 1) AS r1,
      round_even(sqrt(value), 2) AS r2, round_even(sqrt(value), 4) AS r4 FROM events""",
)
def round_even(spark, sf_dir):
    part = F.sqrt("value")
    whole = F.floor("value").cast("double")
    return table(spark, sf_dir, "events").select(
        "event_id",
        numeric.round_even(whole / 2, 0).alias("tie0"),
        numeric.round_even(whole / 8, 2).alias("tie2"),
        *[numeric.round_even(part, n).alias(f"r{n}") for n in (0, 1, 2, 4)],
    )


@query(
    "f05_error_terms",
    over(
        "backtest",
        """ SELECT commodity, obs_date, round(abs(actual - prediction), 6) AS absolute,
          round((actual - prediction) * (actual - prediction), 6) AS squared,
          round(sqrt(actual), 6) AS root FROM backtest""",
    ),
)
def error_terms(spark, sf_dir):
    error = F.col("actual") - F.col("prediction")
    rows = series.naive_backtest(short_daily(spark, sf_dir)).select(
        *SERIES_DAY,
        F.abs(error).alias("absolute"),
        F.pow(error, 2).alias("squared"),
        F.sqrt("actual").alias("root"),
    )
    return rounded(rows, "absolute", "squared", "root")


@query(
    "f06_floor_at_zero",
    over(
        "short_anomaly",
        """ SELECT obs_date, region, commodity,
          greatest(0, cast(price AS bigint) - 50) AS price FROM short_anomaly""",
    ),
)
def floor_at_zero(spark, sf_dir):
    return short_panel(spark, sf_dir).select(
        "obs_date", *ENTITY, numeric.floor_at_zero(numeric.safe_int(F.col(PRICE) - 50)).alias(PRICE)
    )


@query(
    "f07_days_after",
    over(
        "daily",
        """ SELECT commodity, obs_date, cast(obs_date + 7 AS date) AS target_date FROM daily""",
    ),
)
def days_after(spark, sf_dir):
    return daily(spark, sf_dir).select(
        *SERIES_DAY, numeric.days_after("obs_date", 7).alias("target_date")
    )


@query(
    "f08_iso_date",
    over("daily", " SELECT commodity, strftime(obs_date, '%Y-%m-%d') AS date_text FROM daily"),
)
def iso_date(spark, sf_dir):
    return daily(spark, sf_dir).select("commodity", text.iso_date_text("obs_date").alias("date_text"))


@query(
    "f09_min_max_scale",
    over(
        "daily",
        """, ends AS (SELECT commodity, min(price) AS lo, max(price) AS hi FROM daily GROUP BY 1)
        SELECT commodity, obs_date, round((price - lo) / (hi - lo), 6) AS scaled,
          round(price, 6) AS restored FROM daily JOIN ends USING (commodity)""",
    ),
)
def min_max_scale(spark, sf_dir):
    days = daily(spark, sf_dir)
    ends = series.scaling_statistics(days, [PRICE])
    scaled = series.scale_series(days, ends, [PRICE]).join(ends, "commodity")
    restored = numeric.min_max_unscale(PRICE, f"{PRICE}_min", f"{PRICE}_max")
    return rounded(
        scaled.select(*SERIES_DAY, F.col(PRICE).alias("scaled"), restored.alias("restored")),
        "scaled",
        "restored",
    )


@query("f10_calendar", over("calendar", " SELECT * FROM calendar"))
def calendar_columns(spark, sf_dir):
    return panels.calendar_of(panels.price_parts(spark, sf_dir))


_DOTS = "replace(format('{{:,}}', cast({} AS bigint)), ',', '.')"


@query(
    "f11_number_text",
    over(
        "panel",
        f""" SELECT obs_date, region, commodity,
          CASE WHEN is_weekend = 1 THEN '-' ELSE {_DOTS.format("price * 1000")} END AS plain,
          'Rp ' || {_DOTS.format("price")} AS money FROM panel""",
    ),
)
def number_text(spark, sf_dir):
    known = F.when(F.col("is_weekend") != 1, F.col(PRICE) * 1000)
    return panel(spark, sf_dir).select(
        "obs_date",
        *ENTITY,
        text.number_text(known).alias("plain"),
        text.money_text(PRICE).alias("money"),
    )


@query(
    "f12_percent_text",
    over(
        "anomaly",
        """ SELECT obs_date, region, commodity, CASE WHEN previous_price IS NULL THEN '-'
          ELSE printf('%.1f%%', round(rain_mm / 4, 1)) END AS shown FROM anomaly""",
    ),
)
def percent_text(spark, sf_dir):
    known = F.when(F.col("previous_price").isNotNull(), F.col("rain_mm") / 4)
    return anomaly.with_previous_price(panel(spark, sf_dir)).select(
        "obs_date", *ENTITY, text.percent_text(known).alias("shown")
    )


@query(
    "f13_signed_percent",
    over(
        "anomaly",
        """ SELECT obs_date, region, commodity, CASE WHEN d >= 0 THEN '+' ELSE '' END
          || regexp_replace(cast(cast(d AS decimal(24,1)) AS varchar), '\\.0$', '') || '%' AS shown
        FROM (SELECT *, round_even(deviation_pct, 1) + 0 AS d FROM anomaly)""",
    ),
)
def signed_percent(spark, sf_dir):
    rows = anomaly.anomaly_rows(panel(spark, sf_dir))
    shown = text.signed_percent_text(numeric.round_even("deviation_pct", 1))
    return rows.select("obs_date", *ENTITY, shown.alias("shown"))


@query(
    "f14_flag_text",
    over(
        "panel",
        """ SELECT obs_date, region, commodity,
          CASE WHEN is_holiday = 1 THEN 'Ya' ELSE '-' END AS shown FROM panel""",
    ),
)
def flag_text(spark, sf_dir):
    return panel(spark, sf_dir).select(
        "obs_date", *ENTITY, text.flag_text("is_holiday").alias("shown")
    )


@query(
    "f15_json_record",
    over(
        "baseline",
        """ SELECT cast(to_json({'commodity': commodity, 'step': step, 'target_date': target_date,
          'price': price, 'mae': mae, 'gap': NULL}) AS varchar) AS record FROM baseline""",
    ),
)
def json_record(spark, sf_dir):
    rows = short_forecast(spark, sf_dir).select(
        "commodity", "step", "target_date", "price", "mae", F.lit(None).cast("int").alias("gap")
    )
    return batch.as_json(rows)


@query(
    "f16_metric_arrays",
    over(
        "baseline",
        """ SELECT commodity, min(mae) AS mae, min(rmse) AS rmse, min(mape) AS mape,
          string_agg(cast(mae AS bigint), ',' ORDER BY step) AS mae_by_step,
          string_agg(mape, ',' ORDER BY step) AS mape_by_step FROM baseline GROUP BY 1""",
    ),
)
def metric_arrays(spark, sf_dir):
    def joined(name, as_type):
        return F.array_join(F.transform(name, lambda x: x.cast(as_type).cast("string")), ",")

    return report.metric_arrays(short_forecast(spark, sf_dir)).withColumns(
        {
            "mae_by_step": joined("mae_by_step", "bigint"),
            "mape_by_step": joined("mape_by_step", "double"),
        }
    )


@query("f16_forecast_records")
def forecast_records(spark, sf_dir):
    rows = predictions(spark, sf_dir)
    days = daily(spark, sf_dir)
    return report.forecast_records(
        forecast.forecast_from_predictions(rows, days),
        forecast.backtest(rows),
        series.history_tail(days),
    )


# Display tables and nested records, on results that SQL can compute too.

@query(
    "r01_backtest_chart",
    over(
        "backtest",
        """ SELECT commodity, obs_date AS origin_date, cast(round_even(actual, 0) AS bigint) AS actual,
          cast(round_even(prediction, 0) AS bigint) AS prediction FROM backtest""",
    ),
)
def backtest_chart(spark, sf_dir):
    tested = series.naive_backtest(short_daily(spark, sf_dir))
    return report.evaluation_chart(
        tested.withColumn("step", F.lit(1)).withColumnRenamed("obs_date", "origin_date")
    )


@query(
    "r02_anomaly_record",
    over(
        "flagged",
        """ SELECT count(*) AS total_rows, cast(sum(is_anom) AS bigint) AS total_anomalies,
          (SELECT count(*) FROM (SELECT DISTINCT obs_date FROM flagged)) AS days,
          cast(least(50, sum(is_anom)) AS bigint) AS n_top,
          (SELECT cast(min(obs_date) AS varchar) FROM flagged) AS first_day FROM flagged""",
    ),
)
def anomaly_record(spark, sf_dir):
    """The report as one JSON record, read again."""
    record = report.anomaly_record(plain_flagged(spark, sf_dir), "plain")
    read = F.from_json(
        "record",
        "total_rows bigint, total_anomalies bigint, top array<struct<date:string>>,"
        " daily array<struct<date:string,n_anomalies:bigint>>",
    )
    return record.select(read.alias("r")).select(
        "r.total_rows",
        "r.total_anomalies",
        F.size("r.daily").cast("bigint").alias("days"),
        F.size("r.top").cast("bigint").alias("n_top"),
        F.col("r.daily")[0]["date"].alias("first_day"),
    )


# Forecast and anomaly operators.


@query(
    "m01_series_path",
    over(
        "daily short_daily",
        """ SELECT commodity, count(*) AS n_days,
          CASE WHEN count(*) >= 61 AND count(temp_avg_c) > 0 AND count(rain_mm) > 0
            AND count(humidity_avg_pct) > 0 THEN 'model' ELSE 'baseline' END AS path
        FROM (FROM daily UNION ALL FROM short_daily) GROUP BY 1""",
    ),
)
def series_path(spark, sf_dir):
    return series.series_path(both_daily(spark, sf_dir))


@query("m02_baseline_forecast", over("baseline", " SELECT * FROM baseline"))
def baseline_forecast(spark, sf_dir):
    return short_forecast(spark, sf_dir)


_LAST_DAYS = """SELECT commodity, max(obs_date) AS last_date, count(*) AS n_days,
    greatest(count(*) - 36, 0) AS n_samples FROM daily GROUP BY 1"""
_STEPS = "CROSS JOIN range(1, 8) AS steps(step)"


@query(
    "m03_forecast_frame",
    over(
        "daily",
        f""" SELECT commodity, cast(step AS int) AS step,
          cast(last_date + cast(step AS int) AS date) AS target_date, true AS valid
        FROM ({_LAST_DAYS}) {_STEPS}""",
    ),
)
def model_forecast_frame(spark, sf_dir):
    """What a model forecast has whatever its fit: steps, dates, prices not below 0."""
    valid = F.coalesce(F.col(PRICE) >= 0, F.lit(False))
    return forecast.model_forecast(predictions(spark, sf_dir)).select(
        "commodity", "step", "target_date", valid.alias("valid")
    )


@query(
    "m03_backtest_actuals",
    over(
        "daily",
        """, numbered AS (SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY obs_date) - 1 AS i,
            count(*) OVER (PARTITION BY commodity) AS n FROM daily),
        split AS (SELECT commodity, n - 36 AS samples,
            greatest(1, least(cast(floor((n - 36) * 0.8) AS bigint), n - 37)) AS n_train
          FROM (SELECT DISTINCT commodity, n FROM numbered))
        SELECT o.commodity, cast(step AS int) AS step, o.obs_date AS origin_date, round(t.price, 6) AS actual
        FROM numbered o JOIN split USING (commodity) CROSS JOIN range(1, 8) AS steps(step)
        JOIN numbered t ON t.commodity = o.commodity AND t.i = o.i + step - 1
        WHERE o.i >= 30 + n_train AND o.i < 30 + samples""",
    ),
)
def backtest_actuals(spark, sf_dir):
    """The hold-out part of every series: samples, dates and true prices."""
    rows = forecast.backtest(predictions(spark, sf_dir))
    return rounded(rows.select("commodity", "step", "origin_date", "actual"), "actual")


_RIDGE_OF_ONE_DAY = over(
    "daily",
    """, numbered AS (SELECT commodity, obs_date, price, row_number() OVER by_day - 1 AS i,
        lead(price) OVER by_day AS next_price, lead(obs_date) OVER by_day AS next_date,
        count(*) OVER (PARTITION BY commodity) AS n
      FROM daily WINDOW by_day AS (PARTITION BY commodity ORDER BY obs_date)),
    split AS (SELECT *, greatest(1, least(cast(floor((n - 1) * 0.8) AS bigint), n - 2)) AS n_train FROM numbered),
    limits AS (SELECT commodity, min(price) AS low, coalesce(nullif(max(price) - min(price), 0), 1) AS span
      FROM split WHERE i <= n_train GROUP BY 1),
    scaled AS (SELECT *, (price - low) / span AS x, (next_price - low) / span AS y
      FROM split JOIN limits USING (commodity)),
    centres AS (SELECT commodity, avg(x) AS mx, avg(y) AS my FROM scaled WHERE i < n_train GROUP BY 1),
    slopes AS (SELECT commodity, mx, my, sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + 1) AS slope
      FROM scaled JOIN centres USING (commodity) WHERE i < n_train GROUP BY ALL)
    SELECT commodity, CASE WHEN i = n - 1 THEN 'forecast' ELSE 'test' END AS kind,
      CASE WHEN i = n - 1 THEN obs_date ELSE next_date END AS origin_date,
      round((my + slope * (x - mx)) * span + low, 3) AS prediction
    FROM scaled JOIN slopes USING (commodity) WHERE i >= n_train""",
)


@query("m03_ridge_of_one_day", _RIDGE_OF_ONE_DAY)
def ridge_of_one_day(spark, sf_dir):
    """The ridge fit from one day's price to the next, small enough for SQL to solve."""
    rows = forecast.ridge_predictions(daily(spark, sf_dir), days=1, horizon=1, inputs=[PRICE])
    return rounded(rows.select("commodity", "kind", "origin_date", "prediction"), "prediction", places=3)


@query("m03_ridge_in_blocks", _RIDGE_OF_ONE_DAY)
def ridge_of_blocks(spark, sf_dir):
    """The same fit, its normal equations summed over blocks of 64 samples."""
    rows = ridge_in_blocks(daily(spark, sf_dir), days=1, horizon=1, inputs=[PRICE], block=64)
    return rounded(rows.select("commodity", "kind", "origin_date", "prediction"), "prediction", places=3)


@query("m03_model_forecast")
def model_forecast(spark, sf_dir):
    return forecast.model_forecast(predictions(spark, sf_dir))


@query(
    "m04_forecast_frame",
    over(
        "daily baseline",
        f""" SELECT commodity, step, target_date, n_days, n_samples, model, price, mae FROM baseline
        UNION ALL SELECT commodity, cast(step AS int), cast(last_date + cast(step AS int) AS date), n_days,
          n_samples, '{forecast.RIDGE_MODEL}', NULL, NULL FROM ({_LAST_DAYS}) {_STEPS}""",
    ),
)
def all_forecasts_frame(spark, sf_dir):
    """Every series; values of those that take the baseline."""
    rows = forecast.forecast_all(both_daily(spark, sf_dir))
    plain = F.col("model") != forecast.RIDGE_MODEL
    return rows.select(
        "commodity", "step", "target_date", "n_days", "n_samples", "model",
        F.when(plain, F.col(PRICE)).alias(PRICE), F.when(plain, F.col("mae")).alias("mae"),
    )


@query("m04_all_forecasts")
def all_forecasts(spark, sf_dir):
    return forecast.forecast_all(both_daily(spark, sf_dir))


@query(
    "m05_anomaly_features",
    over(
        "anomaly",
        " SELECT obs_date, region, commodity, "
        + ", ".join(f"round({_feature_sql(c)}, 6) AS {c}" for c in ANOMALY_FEATURES)
        + " FROM anomaly",
    ),
)
def anomaly_features(spark, sf_dir):
    return rounded(anomaly.anomaly_features(panel(spark, sf_dir)), *ANOMALY_FEATURES)


@query(
    "m06_forest_shape",
    over(
        "panel",
        """ SELECT count(*) AS trees, count(*) AS roots, true AS shallow, least(256, (SELECT count(*) FROM panel)) AS rows
        FROM range(200)""",
    ),
)
def forest_shape(spark, sf_dir):
    """200 trees with a root each, at most 8 splits deep."""
    nodes = fitted_forest(spark, sf_dir).node_table(spark)
    return nodes.agg(
        F.countDistinct("tree").alias("trees"),
        F.sum((F.col("node") == 0).cast("int")).alias("roots"),
        (F.max("node") < 2**9 - 1).alias("shallow"),
        F.max("sample_rows").cast("bigint").alias("rows"),
    )


@query(
    "m07_scored_rows",
    over("panel", " SELECT obs_date, region, commodity, price, true AS in_range FROM panel"),
)
def scored_rows(spark, sf_dir):
    """Every row has a score, in [-1, 0)."""
    inside = F.coalesce((F.col("score") >= -1) & (F.col("score") < 0), F.lit(False))
    rows = forest_scored(spark, sf_dir).select("obs_date", *ENTITY, PRICE, inside.alias("in_range"), "copies")
    return expand_copies(rows)


@query(
    "m08_flagged_share",
    over(
        "panel",
        """ SELECT count(*) AS total_rows, true AS in_share, count(DISTINCT obs_date) AS days FROM panel""",
    ),
)
def flagged_share(spark, sf_dir):
    """All rows are counted, at most 3 % are flagged, and every date is there."""
    flagged = forest_flagged(spark, sf_dir)
    summary = anomaly.anomaly_summary(flagged, forest.FOREST_MODEL)
    days = anomaly.anomaly_daily(flagged).agg(F.count(F.lit(1)).alias("days"), F.sum("n_anomalies").alias("n"))
    few = (F.col("total_anomalies") <= F.ceil(F.col("total_rows") * 0.03)) & (F.col("n") == F.col("total_anomalies"))
    return report.in_one_row(summary, days).select("total_rows", few.alias("in_share"), "days")


@query("m06_forest_nodes")
def forest_nodes(spark, sf_dir):
    return fitted_forest(spark, sf_dir).node_table(spark)


@query("m07_forest_scores")
def forest_scores(spark, sf_dir):
    return forest_scored(spark, sf_dir).select("obs_date", *ENTITY, PRICE, "score")


@query("m08_forest_summary")
def forest_summary(spark, sf_dir):
    return anomaly.anomaly_summary(forest_flagged(spark, sf_dir), forest.FOREST_MODEL)


@query("m08_forest_top")
def forest_top(spark, sf_dir):
    return report.anomaly_table(anomaly.top_anomalies(forest_flagged(spark, sf_dir)))


@query("m08_forest_daily")
def forest_daily(spark, sf_dir):
    return anomaly.anomaly_daily(forest_flagged(spark, sf_dir))


@query(
    "m09_batch_run",
    over(
        "daily",
        f" SELECT commodity, n_days, n_samples, '{forecast.RIDGE_MODEL}' AS model FROM ({_LAST_DAYS})",
    ),
)
def batch_run(spark, sf_dir):
    tables = batch.run_batch(panel(spark, sf_dir), scratch_path(spark, "results"))
    return tables["series_meta"]


# Streaming.

_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream of panel rows.

    A pattern, because a stream cannot be based on the name of one file.
    """
    events = feed.read_feed(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema=_EVENTS)
    region_id = (F.col("user_id") % 15).cast("int")
    none = {c: F.lit(None).cast("double") for c in WEATHER}
    return events.select(
        "event_id",
        feed.clock_time("ts").alias("ts"),
        F.col("ts").cast("date").alias("obs_date"),
        F.concat(F.lit("R"), region_id.cast("string")).alias("region"),
        region_id.alias("region_id"),
        F.col("event_type").alias("commodity"),
        F.col("value").alias(PRICE),
    ).withColumns(none)


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the event dates, stored once."""
    dates = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("obs_date"))
    return once(
        spark, sf_dir, "event_calendar", lambda: written(panels.calendar_of(dates), "event_calendar")
    )


_FEED_SQL = """SELECT event_id, cast(ts AS date) AS obs_date, event_type AS commodity,
    value AS price FROM events"""
_FEED_COLUMNS = ["event_id", "obs_date", "commodity", PRICE]


def _closed_sql(days: int) -> str:
    return f"""SELECT event_type AS commodity, cast(ts AS date) AS obs_date,
        round(avg(value), 6) AS price, count(*) AS n_rows FROM events GROUP BY 1, 2
      HAVING cast(ts AS date) + INTERVAL {days + 1} DAY <= (SELECT max(ts) FROM events)"""


@query("s07_streaming_source", _FEED_SQL)
def streaming_source(spark, sf_dir):
    return feed.drained(event_feed(spark, sf_dir).select(*_FEED_COLUMNS), "feed")


@query("st1_ingest", _FEED_SQL + " WHERE value >= 20")
def stream_ingest(spark, sf_dir):
    price = F.when(F.col(PRICE) >= 20, F.col(PRICE))
    rows = feed.ingest(event_feed(spark, sf_dir).withColumn(PRICE, price))
    return feed.drained(rows.select(*_FEED_COLUMNS), "ingest")


@query("st2_drop_replays", _FEED_SQL)
def stream_drop_replays(spark, sf_dir):
    """The feed with each event twice, first without its price; each comes out once, with it."""
    priced = F.explode(F.array(F.lit(False), F.lit(True)))
    twice = event_feed(spark, sf_dir).withColumn("_priced", priced)
    twice = twice.withColumn(PRICE, F.when(F.col("_priced"), F.col(PRICE))).drop("_priced")
    twice = feed.combine_replays(twice, ["event_id"])
    rows = feed.drop_replays(feed.ingest(twice, "60 days"), ["event_id"])
    return feed.drained(rows.select(*_FEED_COLUMNS), "replays")


@query("st3_daily_means", _closed_sql(1))
def stream_daily_means(spark, sf_dir):
    rows = feed.daily_means(feed.ingest(event_feed(spark, sf_dir)))
    return rounded(feed.drained(rows, "daily-means"), PRICE)


@query("st4_late_data_delay", _closed_sql(5))
def stream_late_data(spark, sf_dir):
    """A longer delay keeps more days open."""
    rows = feed.daily_means(feed.ingest(event_feed(spark, sf_dir), "5 days"))
    return rounded(feed.drained(rows, "delayed-means"), PRICE)


@query(
    "st5_calendar_enrichment",
    over(
        "event_calendar",
        f""" SELECT event_id, e.commodity, {", ".join(CALENDAR)}
        FROM ({_FEED_SQL}) e JOIN event_calendar USING (obs_date)""",
    ),
)
def stream_calendar(spark, sf_dir):
    dates = event_calendar(spark, sf_dir)
    rows = feed.with_calendar(feed.ingest(event_feed(spark, sf_dir)), dates)
    return feed.drained(rows.select("event_id", "commodity", *CALENDAR), "calendar")


def event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of daily weather by region, made of the events; the first region has none."""

    def store():
        region_id = (F.col("user_id") % 15).cast("int")
        path = scratch_path(spark, "event-weather")
        (
            table(spark, sf_dir, "events")
            .where(region_id > 0)
            .groupBy(
                F.col("ts").cast("date").alias("obs_date"),
                F.concat(F.lit("R"), region_id.cast("string")).alias("region"),
            )
            .agg(
                F.max("value").alias("temp_avg_c"),
                F.count(F.lit(1)).cast("double").alias("rain_mm"),
                F.min("value").alias("humidity_avg_pct"),
            )
            .write.parquet(path)
        )
        return path

    path = once(spark, sf_dir, "event_weather", store)
    fields = "obs_date date, region string, temp_avg_c double, rain_mm double, humidity_avg_pct double"
    return feed.read_feed(spark, path, schema=T.StructType.fromDDL(fields))


@query(
    "st5_live_feeds",
    over(
        "event_calendar",
        f""", rows AS (SELECT event_id, event_type AS commodity, 'R' || (user_id % 15) AS region, value AS price,
            cast(ts AS date) AS obs_date FROM events WHERE value IS NOT NULL),
        weather AS (SELECT obs_date, region, max(price) AS temp_avg_c, cast(count(*) AS double) AS rain_mm,
            min(price) AS humidity_avg_pct FROM rows WHERE region <> 'R0' GROUP BY 1, 2)
        SELECT event_id, commodity, r.region, price, r.obs_date, {", ".join(f"w.{c}" for c in WEATHER)}, {", ".join(CALENDAR)}
        FROM rows r LEFT JOIN weather w ON w.obs_date = r.obs_date AND w.region = r.region
          JOIN event_calendar c ON c.obs_date = r.obs_date
        WHERE w.region IS NOT NULL OR r.obs_date + 1 <= least((SELECT max(obs_date) FROM rows), (SELECT max(obs_date) FROM weather))""",
    ),
)
def stream_live_feeds(spark, sf_dir):
    """Prices and weather as two streams; rows without weather come when their day is closed."""
    rows = feed.join_live_feeds(event_feed(spark, sf_dir), event_weather(spark, sf_dir), event_calendar(spark, sf_dir))
    columns = ["event_id", "commodity", "region", PRICE, "obs_date", *WEATHER, *CALENDAR]
    return feed.drained(rows.select(*columns), "live-feeds")


@query("st6_alerts")
def stream_alerts(spark, sf_dir):
    found = once(
        spark, sf_dir, "short_run", lambda: batch.detect_anomalies(short_panel(spark, sf_dir))
    )
    dates = event_calendar(spark, sf_dir)
    rows = feed.with_calendar(feed.ingest(event_feed(spark, sf_dir)), dates)
    root = scratch_path(spark, "alerts")
    alerts.start_alerts(
        rows, found.forest, found.threshold, root, scratch_path(spark, "alerts-progress")
    ).awaitTermination()
    return alerts.read_alerts(spark, root)
