import datetime as dt
import json
import math

import numpy as np
import pytest

from marketloom.operators import block_ridge, forecast, report, series
from marketloom.schema import MODEL_INPUTS


def wave(n):
    return [100 + 20 * math.sin(d / 5) + d % 7 for d in range(n)]


@pytest.fixture(scope="module")
def panel(make_panel):
    rows = []
    for d, p in enumerate(wave(120)):
        common = {"day": d, "weekday_idx": d % 7, "month": d // 30, "rain_mm": float(d % 3)}
        rows.append({**common, "price": p})
        rows.append({**common, "commodity": "flat", "price": 70.0})
        if d < 40:
            rows.append({**common, "commodity": "short", "price": 5.0 + d})
    return make_panel(rows)


@pytest.fixture(scope="module")
def daily(panel):
    return series.daily_series(panel).persist()


@pytest.fixture(scope="module")
def predictions(daily):
    return forecast.ridge_predictions(forecast.split_paths(daily)[0]).persist()


def plain_ridge(values, days, horizon, n_train):
    """The same regression written as one augmented least-squares problem."""
    seen = values[: days + n_train]
    low, span = seen.min(axis=0), seen.max(axis=0) - seen.min(axis=0)
    span[span == 0] = 1
    z = (values - low) / span
    x = np.array([z[i : i + days].ravel() for i in range(len(z) - days + 1)])
    y = np.array([z[i + days : i + days + horizon, 0] for i in range(n_train)])
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.eye(design.shape[1])
    penalty[-1, -1] = 0
    a = np.vstack([design[:n_train], penalty])
    b = np.vstack([y, np.zeros((design.shape[1], horizon))])
    weights = np.linalg.lstsq(a, b, rcond=None)[0]
    return (design @ weights) * span[0] + low[0]


def test_same_as_least_squares(daily, predictions):
    rows = daily.where("commodity = 'rice'").orderBy("obs_date").toPandas()
    values = rows[MODEL_INPUTS].to_numpy("float64")
    n_samples, n_train = 84, 67
    expected = plain_ridge(values, 30, 7, n_train)
    got = predictions.where("commodity = 'rice'").toPandas()
    ahead = got[got.kind == "forecast"].sort_values("step").prediction
    assert np.allclose(ahead, expected[-1])
    test = got[got.kind == "test"].sort_values(["origin_date", "step"])
    assert np.allclose(test.prediction, expected[n_train:n_samples].ravel())
    actual = [values[30 + s : 37 + s, 0] for s in range(n_train, n_samples)]
    assert np.allclose(test.actual, np.ravel(actual))
    assert test.origin_date.iloc[0] == rows.obs_date.iloc[30 + n_train]


def test_every_series_gets_seven_days(daily, predictions, day0):
    rows = forecast.forecast_all(daily, predictions).collect()
    assert len(rows) == 21
    last = {"rice": 119, "flat": 119, "short": 39}
    for row in rows:
        assert row.target_date == day0 + dt.timedelta(days=last[row.commodity] + row.step)
        assert row.price >= 0
    one = {(r.commodity, r.step): r for r in rows if r.model == forecast.RIDGE_MODEL}
    for row in forecast.model_forecast(predictions).collect():
        same = one[row.commodity, row.step]
        assert (same.price, same.target_date) == (row.price, row.target_date)
    for row in forecast.forecast_metrics(predictions).collect():
        same = one[row.commodity, row.step]
        assert (same.mae, same.rmse, same.mape) == (row.mae, row.rmse, row.mape)
    meta = {r.commodity: r for r in forecast.series_meta(forecast.forecast_all(daily, predictions)).collect()}
    assert meta["short"].model == forecast.baseline_forecast(daily).first().model
    assert meta["rice"].model == forecast.RIDGE_MODEL
    assert (meta["rice"].n_days, meta["rice"].n_samples) == (120, 84)


def test_constant_series(predictions):
    rows = forecast.model_forecast(predictions).where("commodity = 'flat'").collect()
    assert {r.price for r in rows} == {70}
    errors = forecast.forecast_metrics(predictions).where("commodity = 'flat'").collect()
    assert {(r.mae, r.rmse, r.mape) for r in errors} == {(0.0, 0.0, 0.0)}


def test_forecast_is_never_negative(make_series):
    falling = series.daily_series(make_series([1000 - 15 * d for d in range(66)]))
    rows = forecast.model_forecast(forecast.ridge_predictions(falling)).collect()
    assert len(rows) == 7 and min(r.price for r in rows) >= 0


def test_partitioning_does_not_matter(daily, predictions):
    again = forecast.ridge_predictions(daily.where("commodity <> 'short'").repartition(5, "obs_date"))
    key = ["commodity", "kind", "step", "origin_date"]
    a = predictions.toPandas().sort_values(key).reset_index(drop=True)
    b = again.toPandas().sort_values(key).reset_index(drop=True)
    assert np.allclose(a.prediction, b.prediction)


@pytest.mark.parametrize("block", [37, 40, 84, 4096])
def test_blocks_give_the_same_fit(daily, predictions, block):
    """However a series is cut, with the last run in the last block or alone in one."""
    rows = daily.where("commodity <> 'short'")
    key = ["commodity", "kind", "step", "origin_date"]
    a = predictions.toPandas().sort_values(key).reset_index(drop=True)
    b = block_ridge.ridge_in_blocks(rows, block=block).toPandas().sort_values(key).reset_index(drop=True)
    assert a[key].equals(b[key])
    assert np.allclose(a.prediction, b.prediction, rtol=1e-9, atol=0)
    assert np.allclose(a.actual, b.actual, rtol=1e-12, atol=0, equal_nan=True)


def test_purge_leaves_out_samples(daily, predictions):
    purged = forecast.ridge_predictions(daily.where("commodity = 'rice'"), purge=6)
    a = forecast.backtest(purged).orderBy("origin_date", "step").toPandas()
    b = forecast.backtest(predictions).where("commodity = 'rice'").orderBy("origin_date", "step").toPandas()
    assert np.allclose(a.actual, b.actual) and not np.allclose(a.prediction, b.prediction)


def test_chart_joins_history_and_forecast(daily, predictions):
    rows = forecast.forecast_chart(daily, forecast.forecast_all(daily, predictions))
    one = rows.where("commodity = 'rice'").toPandas()
    assert (one.kind == "history").sum() == 60 and (one.kind == "forecast").sum() == 8
    assert one[one.kind == "forecast"].obs_date.min() == one[one.kind == "history"].obs_date.max()


def test_records(daily, predictions):
    rows = report.forecast_records(
        forecast.forecast_all(daily, predictions),
        forecast.backtest(predictions),
        series.history_tail(daily),
    )
    found = {r.commodity: json.loads(r.record) for r in rows.collect()}
    rice = found["rice"]
    assert [f["step"] for f in rice["forecast"]] == list(range(1, 8))
    assert len(rice["mae_by_step"]) == 7 and rice["mae"] == rice["mae_by_step"][0]
    assert len(rice["history"]) == 60 and len(rice["backtest"]) == 17
    dates = [h["date"] for h in rice["history"]]
    assert dates == sorted(dates)
    assert found["short"]["backtest"] is None
    table = report.forecast_table(forecast.forecast_all(daily, predictions))
    assert table.where("commodity = 'flat' and step = 2").first().price_text == "Rp 70"
