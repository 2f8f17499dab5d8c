"""Model swap, message logs, two-stage replays, corrections, the movable feast and running quantiles."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from marketloom.functions.calendar import days_to_feast, feast_date
from marketloom.operators import sketch
from marketloom.plans.serving import THRESHOLD, _SECOND, literal_forest
from marketloom.schema import PANEL_COLUMNS, PANEL_SCHEMA
from marketloom.sources import panel as files
from marketloom.streaming import alerts, feed, keyed, log_source
from marketloom.streaming.models import ModelStore


@pytest.fixture(scope="module")
def panel(make_panel):
    return make_panel(
        [
            {"day": d, "region": r, "region_id": i, "price": float(20 + (d * 5 + i * 3) % 13)}
            for d in range(40)
            for i, r in enumerate("ABCD")
        ]
    ).persist()


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


# Model swap


def test_a_batch_takes_the_newest_model_and_keeps_it(spark, panel, tmp_path):
    models = ModelStore(str(tmp_path / "models"))
    assert models.newest(spark) is None
    writer = alerts.AlertWriter(str(tmp_path / "out"), None, None, models=models)
    days = panel.select(*PANEL_COLUMNS)
    first, second = days.where(F.col("obs_date") < day(5)), days.where(F.col("obs_date").between(day(5), day(9)))
    with pytest.raises(ValueError, match="no model"):
        alerts.AlertWriter(str(tmp_path / "none"), None, None, models=models)(first, 0)

    def scores():
        rows = alerts.read_alerts(spark, str(tmp_path / "out"))
        return {(r.batch_id, r.obs_date, r.region, r.price): r.score for r in rows.collect()}

    assert models.publish(spark, literal_forest(), 0.0) == 1  # every row is an alert
    writer(first, 0)
    before = scores()
    assert models.publish(spark, literal_forest(_SECOND), 0.0) == 2
    writer(second, 1)
    swapped = scores()
    assert len(before) == 20 and len(swapped) == 40
    assert models.publish(spark, literal_forest(), THRESHOLD) == 3
    writer(second, 1)  # run again: the model it took
    assert scores() == swapped

    only_first = alerts.AlertWriter(str(tmp_path / "fixed"), literal_forest(), 0.0)
    only_first(first, 0)
    only_first(second, 1)
    fixed = {
        (r.batch_id, r.obs_date, r.region, r.price): r.score
        for r in alerts.read_alerts(spark, str(tmp_path / "fixed")).collect()
    }
    assert {k: v for k, v in fixed.items() if k[0] == 0} == before
    assert {k: v for k, v in fixed.items() if k[0] == 1} != {k: v for k, v in swapped.items() if k[0] == 1}


def test_a_stored_model_is_the_published_one(spark, tmp_path):
    models = ModelStore(str(tmp_path))
    version = models.publish(spark, literal_forest(_SECOND), -0.5)
    forest, threshold = ModelStore(str(tmp_path)).load(spark, version)
    assert threshold == -0.5
    order = ["tree", "node"]
    got, want = (f.nodes.sort_values(order).reset_index(drop=True) for f in (forest, literal_forest(_SECOND)))
    assert got.astype(str).equals(want.astype(str))


# Keyed state


def test_keyed_alerts_are_those_of_the_state_table(spark, panel, tmp_path):
    path = str(tmp_path / "feed")

    def stage(days, regions):
        found = panel.where(F.col("obs_date").isin([day(d) for d in days]) & F.col("region").isin(list(regions)))
        found.coalesce(1).write.mode("append").parquet(path)

    shown = ["obs_date", "region", "price", "deviation_pct", "delta_pct", "score"]
    start = panel.where(F.col("obs_date") <= day(3))

    def run(kind):
        rows = feed.ingest(feed.read_feed(spark, path, maxFilesPerTrigger=1))
        root, progress = str(tmp_path / kind), str(tmp_path / f"{kind}-progress")
        if kind == "keyed":
            query = keyed.start_keyed_alerts(spark, rows, literal_forest(), 0.0, root, progress, start)
        else:
            query = alerts.start_alerts(rows, literal_forest(), 0.0, root, progress, start)
        query.awaitTermination()
        got = alerts.read_alerts(spark, root).select(*shown)
        return sorted(map(tuple, got.collect())), query.recentProgress

    stage([4, 5, 6], "ABCD")
    stage([7, 8], "AB")
    stage([9, 10, 11], "ABC")
    first, _ = run("keyed")
    assert first == run("table")[0] and len(first) > 10
    stage([12, 13], "A")
    stage([14, 15], "B")
    second, progress = run("keyed")
    assert second == run("table")[0] and len(second) > len(first)
    # The store is asked for the entities of a batch only.
    touched = [op["numRowsUpdated"] for p in progress for op in p["stateOperators"] if "transformWithState" in op["operatorName"]]
    assert touched and max(touched) <= 3


# Message log


@pytest.mark.parametrize("part_bytes", [1, 7, 64, 10_000])
def test_every_line_is_in_one_part(tmp_path, part_bytes):
    rng = random.Random(part_bytes)
    lines = ["é" * rng.randint(0, 20) for _ in range(50)]
    path = tmp_path / "a.log"
    path.write_bytes("".join(f"{x}\n" for x in lines).encode() + b"not yet comp")
    end = log_source.complete_bytes(str(path))
    assert path.read_bytes()[end:] == b"not yet comp"
    parts = log_source.cut_range("a.log", 0, end, part_bytes)
    got = [found for part in parts for found in log_source.read_lines(str(path), part)]
    assert [line for _, line in got] == lines
    assert [at for at, _ in got] == sorted({at for at, _ in got})


def test_a_restart_reads_on_where_it_stopped(spark, tmp_path):
    log, out, progress = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "progress")
    log.mkdir()

    def append(name, prices, tail=""):
        with open(log / name, "a") as f:
            f.writelines(f'{{"obs_date": "2024-01-0{1 + p % 9}", "commodity": "rice", "price": {p}}}\n' for p in prices)
            f.write(tail)

    def run():
        rows = feed.read_feed(spark, str(log), "message_log", PANEL_SCHEMA, partBytes=100)
        feed.run_to_end(feed.ingest(rows).select("obs_date", "commodity", "price"), out, progress)
        return sorted(r.price for r in spark.read.parquet(out).collect())

    append("a.log", range(10))
    append("b.log", range(10, 13), tail='{"price": ')
    assert run() == list(range(13))
    assert run() == list(range(13))
    append("b.log", [], tail='99, "commodity": "oil"}\nno message\n')
    append("c.log", [20])
    assert run() == [*range(13), 20, 99]


# Replays in two stages


def test_one_hot_key_goes_through_two_stages(spark, panel, tmp_path):
    path = str(tmp_path / "feed")
    hot = panel.limit(1).crossJoin(spark.range(500)).drop("id")
    panel.unionByName(hot).repartition(8).write.parquet(path)
    rows = feed.drop_replays(feed.ingest(feed.read_feed(spark, path)), parts=8)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    query = rows.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True).start(out)
    query.awaitTermination()
    busy = max((p for p in query.recentProgress), key=lambda p: p["numInputRows"])
    # State operators from the sink on: by key, then by key and source part.
    by_key, by_part = (op["numRowsTotal"] for op in busy["stateOperators"])
    assert by_key == 160 and 160 <= by_part <= 160 + 8
    got = spark.read.parquet(out)
    assert got.count() == got.select("obs_date", "region", "commodity").distinct().count() == 160


# Corrections


def test_a_correction_rewrites_its_months_only(spark, panel, tmp_path):
    path = str(tmp_path / "history")
    files.write_history(panel, path)

    def stored_files():
        return {
            os.path.join(folder, name)
            for folder, _, names in os.walk(path)
            for name in names
            if name.endswith(".parquet")
        }

    before = stored_files()
    late = panel.where((F.col("obs_date") == day(3)) & (F.col("region") == "B")).withColumn("price", F.lit(999.0))
    lower = late.withColumn("price", F.lit(5.0))
    new = late.withColumns({"region": F.lit(None).cast("string"), "price": F.lit(7.0)})
    files.correct_history(late.unionByName(lower).unionByName(new), path)
    kept = before & stored_files()
    assert kept and all("file_month=2" in name for name in kept)
    assert not any("file_month=1/" in name for name in kept)
    got = {(r.obs_date, r.region): r.price for r in files.read_history(spark, path).collect()}
    want = {(r.obs_date, r.region): r.price for r in panel.collect()} | {(day(3), "B"): 999.0, (day(3), None): 7.0}
    assert got == want
    files.correct_history(late.limit(0), path)
    with pytest.raises(ValueError, match="no month"):
        files.correct_history(late.withColumn("obs_date", F.lit(None).cast("date")), path)


# Movable feast


def test_feasts_by_stepping_through_months(spark):
    """Months of 30 and 29 days by turns, one day more in eleven of thirty years."""
    start, feasts = dt.date(622, 7, 19), {}  # 1 Muharram of year 1 in the Gregorian calendar
    for year in range(1, 1500):
        leap = year % 30 in (2, 5, 7, 10, 13, 16, 18, 21, 24, 26, 29)
        feasts[year] = start + dt.timedelta(days=30 * 5 + 29 * 4)
        start += dt.timedelta(days=354 + leap)
    known = {1444: dt.date(2023, 4, 22), 1445: dt.date(2024, 4, 10), 1446: dt.date(2025, 3, 31)}
    assert {y: feasts[y] for y in known} == known
    days = [dt.date(1960, 1, 1) + dt.timedelta(days=97 * k) for k in range(300)] + [dt.date(2024, 4, 10), None]
    rows = spark.createDataFrame([(d,) for d in days], "d date")
    for r in rows.select("d", feast_date("d").alias("f"), days_to_feast("d").alias("n")).collect():
        if r.d is None:
            assert r.f is None and r.n is None
            continue
        assert r.n == min(abs((r.d - f).days) for f in feasts.values())
        assert r.f in feasts.values() and abs((r.f - r.d).days) <= 355


# Running quantile


def test_running_quantile_is_near_the_exact_one(spark, tmp_path):
    rng = random.Random(1)
    batches = [[rng.gauss(k, 2) for _ in range(20_000)] for k in range(3)]
    state = sketch.RunningQuantile(str(tmp_path), "score", 0.03)
    assert state.value(spark, 0) is None
    seen = []
    for k, values in enumerate(batches):
        frame = spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "score double").repartition(7)
        state(frame, k)
        state(frame, k)  # run again
        seen += values
        got = state.value(spark, k)
        assert abs(sum(v <= got for v in seen) / len(seen) - 0.03) <= sketch.RANK_ERROR
    state(spark.createDataFrame([], "score double"), 3)
    assert state.value(spark, 3) == got
