import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators import anomaly, series
from marketloom.plans.batch import detect_anomalies
from marketloom.schema import CALENDAR, PANEL_COLUMNS, PANEL_SCHEMA, WEATHER
from marketloom.streaming import alerts, feed


@pytest.fixture(scope="module")
def panel(make_panel):
    return make_panel(
        [
            {"day": d, "region": r, "price": float(20 + (d * 5 + i * 3) % 13)}
            for d in range(10)
            for i, r in enumerate("ABCD")
        ]
    ).persist()


def stage(panel, path, days):
    """One file per batch of days, in the given order."""
    for batch in days:
        dates = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in batch]
        panel.where(F.col("obs_date").isin(dates)).coalesce(1).write.mode("append").parquet(str(path))
    return str(path)


def means(spark, path, delay):
    rows = feed.ingest(feed.read_feed(spark, path, maxFilesPerTrigger=1), delay)
    return feed.drained(feed.daily_means(rows), "means")


def test_stream_equals_batch_on_closed_days(spark, panel, tmp_path):
    path = stage(panel, tmp_path / "feed", [[0, 1], [2, 3, 4], [5, 6, 7], [8, 9]])
    got = means(spark, path, "1 day").select("commodity", "obs_date", "price")
    last_closed = dt.date(2024, 1, 1) + dt.timedelta(days=7)
    expected = series.daily_series(panel).where(F.col("obs_date") <= last_closed)
    assert sorted(got.collect()) == sorted(expected.select(*got.columns).collect())


@pytest.mark.parametrize("zone", ["Asia/Jakarta", "America/New_York"])
def test_days_are_whole_in_any_zone(spark, panel, tmp_path, zone):
    path = stage(panel, tmp_path / "feed", [[0, 1], [2, 3, 4]])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = sorted((r.obs_date.day, r.n_rows) for r in means(spark, path, "1 day").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(1, 4), (2, 4), (3, 4)]


def test_late_days_are_left_out_by_the_delay(spark, panel, tmp_path):
    """Lateness is judged by the watermark of the batch before."""
    path = stage(panel, tmp_path / "feed", [[0, 1], [7, 8], [9], [2, 3], [6]])
    short = {r.obs_date.day - 1 for r in means(spark, path, "1 day").collect()}
    long = {r.obs_date.day - 1 for r in means(spark, path, "7 days").collect()}
    assert short == {0, 1, 7}
    assert long == {0, 1}
    assert {r.obs_date.day - 1 for r in means(spark, path, "6 days").collect()} == {0, 1, 2}


def test_replayed_records_count_once(spark, panel, tmp_path):
    path = stage(panel, tmp_path / "feed", [[0, 1], [1, 2], [0, 1, 2]])
    source = feed.read_feed(spark, path, maxFilesPerTrigger=1)
    rows = feed.drop_replays(feed.ingest(feed.combine_replays(source), "5 days"))
    got = feed.drained(rows, "once")
    assert got.count() == 12 and got.select("obs_date", "region").distinct().count() == 12


def test_gate_and_formats(spark, panel, tmp_path):
    gaps = panel.withColumn("price", F.when(F.col("region") != "A", F.col("price")))
    gaps.write.json(str(tmp_path / "json"))
    rows = feed.ingest(feed.read_feed(spark, str(tmp_path / "json"), "json"))
    assert feed.drained(rows, "gate").count() == 30


def test_calendar_enrichment(spark, panel, tmp_path):
    path = stage(panel, tmp_path / "feed", [range(10)])
    calendar = panel.select("obs_date", "weekday_idx", "month", "is_weekend", "is_holiday",
                            F.lit(77).alias("days_to_eid"), "days_to_christmas").distinct()
    got = feed.drained(feed.with_calendar(feed.ingest(feed.read_feed(spark, path)), calendar), "c")
    assert got.count() == 40 and {r.days_to_eid for r in got.collect()} == {77}


@pytest.fixture(scope="module")
def forest(panel):
    return detect_anomalies(panel, n_trees=10).forest


def run_alerts(spark, path, forest, root, progress, start=None):
    rows = feed.ingest(feed.read_feed(spark, path, maxFilesPerTrigger=1))
    alerts.start_alerts(rows, forest, 0.0, str(root), str(progress), start).awaitTermination()
    return alerts.read_alerts(spark, str(root))


def test_alerts_equal_the_batch_features(spark, panel, forest, tmp_path):
    """With a threshold of 0 every row of a closed day is an alert."""
    path = stage(panel, tmp_path / "feed", [[0, 1], [2, 3, 4], [5], [6, 7, 8, 9]])
    got = run_alerts(spark, path, forest, tmp_path / "out", tmp_path / "progress")
    assert got.select("batch_id").distinct().count() > 1
    columns = ["obs_date", "region", "price", "deviation_pct", "delta_pct"]
    expected = anomaly.anomaly_features(panel).where("obs_date <= '2024-01-08'")
    assert sorted(got.select(*columns).collect()) == sorted(expected.select(*columns).collect())


def test_alerts_start_from_stored_history(spark, panel, forest, tmp_path):
    path = stage(panel, tmp_path / "feed", [[4, 5, 6, 7]])
    start = panel.where("obs_date <= '2024-01-04'")
    got = run_alerts(spark, path, forest, tmp_path / "out", tmp_path / "progress", start)
    expected = anomaly.anomaly_features(panel).where("obs_date in ('2024-01-05', '2024-01-06')")
    columns = ["obs_date", "region", "delta_pct"]
    assert sorted(got.select(*columns).collect()) == sorted(expected.select(*columns).collect())


def test_a_batch_that_runs_again_changes_nothing(spark, panel, forest, tmp_path):
    writer = alerts.AlertWriter(str(tmp_path), forest, 0.0)
    days = panel.select(*PANEL_COLUMNS)
    first, second = days.where("obs_date < '2024-01-05'"), days.where("obs_date >= '2024-01-05'")
    writer(first, 0)
    writer(second, 1)
    before = sorted(map(str, alerts.read_alerts(spark, str(tmp_path)).collect()))
    writer(second, 1)
    writer(first, 0)
    writer(second, 1)
    assert sorted(map(str, alerts.read_alerts(spark, str(tmp_path)).collect())) == before


def test_newest_rows(spark, panel):
    rows = alerts.newest_rows(panel)
    assert rows.schema.fieldNames() == PANEL_SCHEMA.fieldNames()
    assert {(r.region, r.obs_date.day) for r in rows.collect()} == {(r, 10) for r in "ABCD"}


def test_prices_and_weather_as_two_streams(spark, make_panel, tmp_path):
    """Late weather still finds its prices, repeats of it do not multiply them, and a day without any closes."""
    price_path, weather_path, out, progress = (str(tmp_path / n) for n in ("prices", "weather", "out", "progress"))
    columns = ["obs_date", "region", *WEATHER]
    calendar = make_panel([{"day": d, "region": "A", "weekday_idx": d} for d in range(9)]).select("obs_date", *CALENDAR)

    def run(prices, weather):
        make_panel(prices).coalesce(1).write.mode("append").parquet(price_path)
        make_panel(weather).select(columns).coalesce(1).write.mode("append").parquet(weather_path)
        fields = [f for f in PANEL_SCHEMA.fields if f.name in columns]
        feeds = feed.read_feed(spark, price_path), feed.read_feed(spark, weather_path, schema=T.StructType(fields))
        joined = feed.join_live_feeds(*feeds, calendar)
        feed.run_to_end(joined, out, progress)
        rows = spark.read.schema(joined.schema).parquet(out).collect()
        days = sorted(((r.obs_date.day - 1), r.region or "-", r.commodity, r.rain_mm, r.weekday_idx) for r in rows)
        return days

    first = run(
        [{"day": 0, "region": r} for r in ("A", "B", None)] + [{"day": 0, "region": "A", "commodity": "oil"}],
        [{"day": 0, "region": "A", "rain_mm": 5.0}] * 2,
    )
    assert first == [(0, "A", "oil", 5.0, 0), (0, "A", "rice", 5.0, 0)]
    late = run(
        [{"day": 1, "region": "A"}, {"day": 1, "region": "A", "price": None}],
        [{"day": 0, "region": "B", "rain_mm": 7.0}, {"day": 0, "region": "A", "rain_mm": 9.0}],
    )
    assert late == [*first, (0, "B", "rice", 7.0, 0)]
    closed = run([{"day": 4, "region": "A"}], [{"day": 4, "region": "A", "rain_mm": 1.0}])
    gone = [(0, "-", "rice", None, 0), (1, "A", "rice", None, 1)]
    assert sorted(closed, key=str) == sorted([*late, *gone, (4, "A", "rice", 1.0, 4)], key=str)
