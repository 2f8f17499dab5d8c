import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators.integrate import integrate, valid_rows, with_calendar
from marketloom.schema import PANEL_COLUMNS, PANEL_SCHEMA, SOURCE_HEADER, WEATHER, CALENDAR
from marketloom.sources import panel as files

GOOD = "2024-01-05,North,3,rice,12500.5,26.1,0.0,81,4,1,0,1,-3,355"


def csv(tmp_path, *lines, header=SOURCE_HEADER):
    path = tmp_path / "panel.csv"
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def test_typed_scan(spark, tmp_path):
    rows = files.load_csv(spark, csv(tmp_path, GOOD))
    assert rows.schema == PANEL_SCHEMA
    row = rows.first()
    assert row.obs_date == dt.date(2024, 1, 5) and row.price == 12500.5 and row.days_to_eid == -3


def test_bad_cells_become_null(spark, tmp_path):
    bad = GOOD.replace("2024-01-05", "soon").replace("26.1", "warm")
    row = files.load_csv(spark, csv(tmp_path, bad)).first()
    assert row.obs_date is None and row.temp_avg_c is None and row.region == "North"


def test_price_gate(spark, tmp_path):
    lines = [GOOD, GOOD.replace("12500.5", ""), GOOD.replace("12500.5", "n/a"), GOOD.replace("12500.5", "NaN")]
    assert files.scan_csv(spark, csv(tmp_path, *lines)).count() == 4
    assert files.load_csv(spark, csv(tmp_path, *lines)).count() == 1


def test_wrong_header_fails(spark, tmp_path):
    swapped = list(SOURCE_HEADER)
    swapped[5], swapped[6] = swapped[6], swapped[5]
    with pytest.raises(Exception, match="header"):
        files.load_csv(spark, csv(tmp_path, GOOD, header=swapped)).collect()


def test_history_round_trip_reads_only_needed_months(spark, make_panel, tmp_path):
    panel = make_panel([{"day": d, "price": float(d)} for d in range(100)])
    path = str(tmp_path / "history")
    files.write_history(panel, path)
    assert sorted(files.read_history(spark, path).collect()) == sorted(panel.collect())
    some = files.read_history(spark, path, "2024-02-10", "2024-03-01")
    assert some.count() == 21
    assert len({f.rsplit("/", 2)[1] for f in some.inputFiles()}) >= 1
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [((" in plan
    assert "PushedFilters: [IsNotNull(obs_date), GreaterThanOrEqual(obs_date" in plan


def test_cached_leaves_the_callers_cache_alone(make_panel):
    panel = make_panel([{"day": 0}])
    with files.cached(panel) as kept:
        assert kept.storageLevel.useMemory
    assert not panel.storageLevel.useMemory
    panel.persist()
    with files.cached(panel):
        pass
    assert panel.storageLevel.useMemory


def test_integration_keeps_prices_without_weather(spark, make_panel):
    panel = make_panel([{"day": d, "region": r} for d in range(3) for r in "AB"])
    weather = panel.where("region = 'A'").select("obs_date", "region", *WEATHER)
    calendar = panel.select("obs_date", *CALENDAR).distinct()
    prices = panel.drop(*WEATHER, *CALENDAR)
    joined = integrate(prices, weather, calendar)
    assert joined.columns == PANEL_COLUMNS and joined.count() == 6
    assert joined.where(F.col("rain_mm").isNull()).count() == 3
    assert joined.where(F.col("month").isNull()).count() == 0


def test_a_short_calendar_is_broadcast_without_a_job(spark, make_panel):
    panel = make_panel([{"day": d, "region": r} for d in range(3) for r in "AB"])
    calendar = panel.select("obs_date", *CALENDAR).distinct()
    spark.sparkContext.setJobGroup("joining", "no job expected")
    try:
        joined = with_calendar(panel.drop(*CALENDAR), calendar)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("joining")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    joined.collect()
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_valid_rows(make_panel):
    panel = make_panel([{"day": 0, "price": p} for p in (1.0, None, float("nan"), 0.0)])
    assert sorted(r.price for r in valid_rows(panel).collect()) == [0.0, 1.0]
