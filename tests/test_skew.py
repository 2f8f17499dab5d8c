import random
from collections import Counter

import pytest

from panel_defaults import DEFAULTS
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketloom.operators import anomaly, skew


@pytest.fixture(scope="module")
def repeated(make_panel):
    """Keys that repeat, copies of whole rows, and one entity with most rows."""
    rng = random.Random(5)
    rows = []
    for day in range(6):
        for region in ("A", "B", None):
            for _ in range(rng.randint(1, 4)):
                rows.append({"day": day, "region": region, "price": float(rng.randint(1, 5))})
        rows += [{"day": day, "region": "hot", "price": float(rng.randint(1, 9))} for _ in range(25)]
        rows += [{"day": day, "region": "hot", "price": 3.0, "rain_mm": 0.0}] * 30
    return make_panel(rows)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


SHOWN = ["obs_date", "region", "commodity", "price", "rain_mm", "previous_price"]


def test_parts_give_one_order_by_date_and_content(repeated, monkeypatch):
    """Against one window per entity over all rows, copies included."""
    content = F.xxhash64(*repeated.columns)
    order = Window.partitionBy("region", "commodity").orderBy(
        "obs_date", F.pmod(content, F.lit(anomaly._DAY_PARTS)), content
    )
    whole = repeated.withColumn("previous_price", F.lag("price").over(order))
    assert bag(whole, *SHOWN) == bag(anomaly.with_previous_price(repeated), *SHOWN)


def test_building_the_features_runs_no_job(spark, repeated):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job expected")
    try:
        anomaly.anomaly_features(repeated, compact=True)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_copies_are_a_function_of_the_contents(repeated):
    """The compact rows do not depend on how the panel is laid out."""
    shuffled = repeated.orderBy("price", "rain_mm").repartition(7, "region")
    a, b = (anomaly.anomaly_features(p, compact=True) for p in (repeated, shuffled))
    assert bag(a, *a.columns) == bag(b, *a.columns)


def test_lag_is_one_order_of_the_rows(repeated):
    """Prices and previous prices of an entity differ by one first and one last row."""
    rows = anomaly.with_previous_price(repeated).where("region = 'hot'").collect()
    prices = Counter(r.price for r in rows)
    before = Counter(r.previous_price for r in rows)
    assert before.pop(None) == 1
    assert sum((prices - before).values()) == 1


def test_compact_rows_stand_for_all_rows(repeated):
    compact = anomaly.anomaly_features(repeated, compact=True)
    whole = anomaly.anomaly_features(repeated)
    assert compact.count() < whole.count() == repeated.count()
    assert bag(skew.expand_copies(compact), *whole.columns) == bag(whole, *whole.columns)


def test_unique_keys_follow_the_date(make_panel):
    panel = make_panel([{"day": d, "price": float(p)} for d, p in enumerate([5, 3, 8])])
    got = {r.price: r.previous_price for r in anomaly.with_previous_price(panel).collect()}
    assert got == {5.0: None, 3.0: 5.0, 8.0: 3.0}


def test_copies_come_back_in_blocks(make_panel, monkeypatch):
    monkeypatch.setattr(skew, "_COPY_BLOCK", 4)
    panel = make_panel([{"day": 0}] * 11 + [{"day": 1}] + [{"day": 2}] * 4)
    packed = skew.collapse_copies(panel)
    assert sorted(r.copies for r in packed.collect()) == [1, 4, 11]
    assert bag(skew.expand_copies(packed), *panel.columns) == bag(panel, *panel.columns)


@pytest.fixture
def eager_splitting(spark):
    """No broadcasts, and adaptive execution that splits even small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_one_busy_day_is_split_in_the_join(spark, make_panel, eager_splitting):
    """Half of all rows on one date: its partition is cut, and the means are right."""
    columns = make_panel([{"day": 0}]).columns
    one = {c: F.lit(v) for c, v in {**DEFAULTS, "rain_mm": 2.0}.items()}
    busy = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50)
    panel = (
        spark.range(0, 40_000, 1, 8)
        .withColumns({**one, "price": (F.col("id") % 97).cast("double")})
        .withColumns(
            {
                "obs_date": F.date_add(F.lit("2024-01-01").cast("date"), busy.cast("int")),
                "region": F.concat(F.lit("R"), F.col("id").cast("string")),
            }
        )
        .select(*columns)
    )
    joined = anomaly.with_province_mean(panel)
    wrong = joined.withColumn(
        "m", F.avg("price").over(Window.partitionBy("commodity", "obs_date"))
    ).where("abs(m - province_mean) > 1e-9 or province_mean is null")
    assert wrong.count() == 0
    assert joined.count() == 40_000
    joined.write.format("noop").mode("overwrite").save()
    rows = joined.select("region", "province_mean")
    rows.collect()
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
