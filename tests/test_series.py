import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import metrics, series
from marketloom.operators.baseline import baseline_forecast
from marketloom.operators.forecast import forecast_all, forecast_for
from marketloom.operators.profile import dataset_info
from marketloom.schema import PANEL_SCHEMA


def by_day(df):
    return df.orderBy("obs_date").collect()


def test_dataset_info_of_nothing(spark):
    row = dataset_info(spark.createDataFrame([], PANEL_SCHEMA)).first()
    assert (row.total_rows, row.total_regions, row.commodities) == (0, 0, [])
    assert row.first_date is None and row.last_date is None


def test_dataset_info_lists_a_missing_commodity_without_counting_it(make_panel):
    panel = make_panel([{"day": 0, "commodity": c} for c in ("b", None, "a")])
    row = dataset_info(panel).first()
    assert (row.total_rows, row.total_commodities) == (3, 2)
    assert row.commodities == [None, "a", "b"]


@pytest.mark.parametrize(
    "n, path, n_samples",
    [(1, "baseline", 0), (57, "baseline", 21), (58, "baseline", 22), (60, "baseline", 24), (61, "model", 25)],
)
def test_path_by_length(make_series, n, path, n_samples):
    days = series.daily_series(make_series(range(1, n + 1)))
    assert series.series_path(days).first().path == path
    assert series.series_size(days).first().n_samples == n_samples


def test_path_is_baseline_when_an_input_is_never_known(make_series):
    days = series.daily_series(make_series(range(1, 80), rain_mm=None))
    assert series.series_path(days).first().path == "baseline"


@pytest.mark.parametrize("n, tested", [(1, 0), (2, 1), (20, 19), (21, 20), (40, 20)])
def test_backtest_size(make_series, n, tested):
    days = series.daily_series(make_series(range(1, n + 1)))
    assert series.naive_backtest(days).count() == tested
    row = baseline_forecast(days).first()
    assert (row.n_days, row.n_samples) == (n, tested)
    assert (row.mae, row.rmse) == ((1.0, 1.0) if tested else (0.0, 0.0))


def test_single_day_forecast(make_series, day0):
    rows = baseline_forecast(series.daily_series(make_series([42.5]))).orderBy("step").collect()
    assert [r.price for r in rows] == [42] * 7
    assert [r.target_date for r in rows] == [day0 + dt.timedelta(days=k) for k in range(1, 8)]
    assert {(r.mae, r.rmse, r.mape) for r in rows} == {(0.0, 0.0, 0.0)}


def test_no_rows_no_forecast(spark):
    days = series.daily_series(spark.createDataFrame([], PANEL_SCHEMA))
    assert baseline_forecast(days).count() == 0
    assert forecast_all(days).count() == 0


def test_lookup_of_an_unknown_series(make_series):
    rows = baseline_forecast(series.daily_series(make_series([1, 2])))
    assert forecast_for(rows, "rice").count() == 7
    assert forecast_for(rows, "gold").count() == 0


def test_zero_actual_leaves_all_metrics(spark):
    pairs = spark.createDataFrame(
        [("a", 0.0, 50.0), ("a", 10.0, 12.0), ("a", None, 1.0), ("a", 5.0, None), ("b", 0.0, 1.0)],
        "k string, actual double, prediction double",
    )
    got = {r.k: (r.mae, r.rmse, r.mape) for r in metrics.regression_metrics(pairs, ["k"]).collect()}
    assert got == {"a": (2.0, 2.0, 20.0), "b": (0.0, 0.0, 0.0)}
    assert metrics.metric_pairs(pairs).count() == 1


def test_lags_count_rows_across_a_gap(make_series):
    prices = [1, 2, None, None, 3, 4, 5, 6, 7, 8]
    rows = by_day(series.forecast_features(series.daily_series(make_series(prices))))
    assert [r.lag_1 for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7]
    assert rows[7].lag_7 == 1 and rows[7].trend_7 == 7
    assert rows[0].rolling_7 is None and rows[2].rolling_7 == 1.5
    assert [r.label_h7 for r in rows] == [8] + [None] * 7
    assert [r.row_num for r in rows] == list(range(1, 9))


def test_fill_gaps(make_panel):
    rain = [None, float("nan"), 2.0, None, float("nan"), 5.0, None]
    holiday = [None, 1, None, 0, None, None, None]
    panel = make_panel(
        [{"day": d, "rain_mm": r, "is_holiday": h} for d, (r, h) in enumerate(zip(rain, holiday))]
    )
    rows = by_day(series.fill_gaps(panel, ["rain_mm", "is_holiday"]))
    assert [r.rain_mm for r in rows] == [2, 2, 2, 2, 2, 5, 5]
    assert [r.is_holiday for r in rows] == [1, 1, 1, 0, 0, 0, 0]


def test_sequences_and_targets(make_series):
    days = series.daily_series(make_series(range(100, 140)))
    inputs = by_day(series.input_sequences(days))
    targets = by_day(series.target_vectors(days))
    assert len(inputs) == 10 and len(targets) == 40 - 36
    assert [x.price for x in inputs[0].inputs] == list(range(100, 130))
    assert targets[0].targets == list(range(130, 137))
    assert targets[0].obs_date == inputs[0].obs_date


@pytest.mark.parametrize("n, train", [(37, 1), (38, 1), (46, 8), (61, 20)])
def test_chronological_split(make_series, n, train):
    days = series.daily_series(make_series(range(1, n + 1)))
    parts = [r.part for r in by_day(series.chronological_split(days))]
    assert parts == ["train"] * train + ["test"] * (n - 36 - train)
    assert series.train_rows(days).count() == 30 + train


def test_daily_mean_over_regions(make_panel):
    panel = make_panel(
        [
            {"day": 0, "region": "A", "price": 10.0, "is_holiday": None},
            {"day": 0, "region": "B", "price": 20.0, "is_holiday": 1},
            {"day": 0, "region": "B", "commodity": "oil", "price": 7.0},
        ]
    )
    row = series.daily_series(panel, "rice").first()
    assert (row.price, row.is_holiday) == (15.0, 1)
    assert series.daily_series(panel).count() == 2
    assert series.last_values(series.daily_series(panel)).count() == 2


def test_scaling_uses_rows_before_the_test(make_series):
    days = series.daily_series(make_series(range(1, 62)))
    ends = series.scaling_statistics(series.train_rows(days), ["price"])
    assert (ends.first().price_min, ends.first().price_max) == (1, 50)
    scaled = by_day(series.scale_series(days, ends, ["price"]))
    assert scaled[0].price == 0 and scaled[49].price == 1 and scaled[60].price > 1


def test_moving_average_and_tail(make_series):
    days = series.daily_series(make_series(range(1, 100)))
    assert series.moving_average(days).first().mean_price == sum(range(93, 100)) / 7
    assert series.history_tail(days).agg(F.min("price"), F.count("*")).first() == (40.0, 60)
