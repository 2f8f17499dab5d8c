"""Queries of the serving side: a literal forest in both engines, model swap, offsets, corrections, sketches.

A fitted forest has no SQL form, as its trees come from a random sample. Here a
small forest is written down as a node table; Spark walks it like a fitted one
and the SQL as nested conditions, so scores, flags, report tables and alerts are
compared value by value.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.calendar import days_to_feast
from marketloom.operators import anomaly, sketch
from marketloom.operators.forest import Forest
from marketloom.operators.trees import mean_path
from marketloom.plans.catalog import (
    PANEL_LIST,
    _feature_sql,
    event_calendar,
    event_feed,
    features,
    query,
    rounded,
)
from marketloom.plans.oracle import over
from marketloom.plans.panels import panel, table
from marketloom.schema import ANOMALY_FEATURES, CALENDAR, ENTITY, PANEL_SCHEMA, PRICE, WEATHER
from marketloom.scratch import scratch_path
from marketloom.sources import panel as files
from marketloom.streaming import alerts, feed, keyed
from marketloom.streaming.models import ModelStore

SAMPLE_ROWS = 256
# Rows below this score are flagged; the paths of the trees put it between two sums of leaves.
THRESHOLD = -0.6
# (feature, cut) of the three inner nodes of every tree, then the paths of its four leaves.
TREES = [
    ([("deviation_pct", 9.7531), ("deviation_pct", -9.7531), ("delta_pct", 14.2857)], [3.0, 11.0, 8.0, 2.0]),
    ([("delta_pct", -12.3457), ("rain_mm", 4.4321), ("price", 61.2345)], [2.0, 4.0, 12.0, 9.0]),
    ([("is_weekend", 0.5), ("delta_pct", 21.0987), ("days_to_eid", 60.5)], [10.0, 3.0, 7.0, 9.5]),
]
_SECOND = [([(f, c + 1.25) for f, c in splits], paths[::-1]) for splits, paths in TREES]


def literal_forest(trees: list = TREES) -> Forest:
    rows = []
    for tree, (splits, paths) in enumerate(trees):
        rows += [(tree, k, ANOMALY_FEATURES.index(f), cut, None) for k, (f, cut) in enumerate(splits)]
        rows += [(tree, 3 + k, -1, None, path) for k, path in enumerate(paths)]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "path"])
    return Forest(nodes.astype({"threshold": "float64", "path": "float64"}), SAMPLE_ROWS)


def score_sql(trees: list = TREES) -> str:
    """The score of a row of features, as nested conditions."""
    depth = " + ".join(
        f"CASE WHEN {f0} > {c0} THEN CASE WHEN {f2} > {c2} THEN {d} ELSE {c} END"
        f" ELSE CASE WHEN {f1} > {c1} THEN {b} ELSE {a} END END"
        for ((f0, c0), (f1, c1), (f2, c2)), (a, b, c, d) in trees
    )
    return f"-pow(2, -({depth}) / {len(trees) * mean_path(SAMPLE_ROWS)!r})"


def _scored_sql(rows: str, trees: list = TREES) -> str:
    known = ", ".join(f"{_feature_sql(c)} AS {c}" for c in ANOMALY_FEATURES)
    return f"""SELECT *, cast(score < {THRESHOLD} AS int) AS is_anom FROM (SELECT *, {score_sql(trees)} AS score
      FROM (SELECT obs_date, region, commodity, {known} FROM {rows}))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return literal_forest().score(features(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.flag_anomalies(scored(spark, sf_dir), THRESHOLD)


@query(
    "m07_literal_scores",
    over(
        "anomaly",
        f""" SELECT obs_date, region, commodity, price, round(score, 6) AS score, is_anom
        FROM ({_scored_sql("anomaly")})""",
    ),
)
def literal_scores(spark, sf_dir):
    rows = literal_forest().score(anomaly.anomaly_features(panel(spark, sf_dir)))
    shown = ["obs_date", *ENTITY, PRICE, "score", "is_anom"]
    return rounded(anomaly.flag_anomalies(rows, THRESHOLD).select(*shown), "score")


@query(
    "m08_literal_summary",
    over(
        "anomaly",
        f""" SELECT cast(sum(is_anom) AS bigint) AS total_anomalies, count(*) AS total_rows,
          round_even(sum(is_anom) / count(*) * 100, 2) AS pct_anomalies, 'literal' AS model
        FROM ({_scored_sql("anomaly")})""",
    ),
)
def literal_summary(spark, sf_dir):
    return anomaly.anomaly_summary(flagged(spark, sf_dir), "literal")


@query(
    "m08_literal_daily",
    over(
        "anomaly",
        f""" SELECT obs_date, cast(sum(is_anom) AS bigint) AS n_anomalies
        FROM ({_scored_sql("anomaly")}) GROUP BY 1""",
    ),
)
def literal_daily(spark, sf_dir):
    return anomaly.anomaly_daily(flagged(spark, sf_dir))


_TOP = """obs_date, region, commodity, cast(round_even(price, 0) AS bigint) AS price,
          round_even(deviation_pct, 1) AS deviation_pct, round_even(delta_pct, 1) AS delta_pct,
          round_even(rain_mm, 1) AS rain_mm, cast(is_holiday AS int) AS is_holiday, round_even(score, 4) AS score"""


@query(
    "m08_literal_top",
    over(
        "anomaly",
        f""" SELECT {_TOP} FROM ({_scored_sql("anomaly")}) WHERE is_anom = 1
        ORDER BY s.score, obs_date, region, commodity, s.price LIMIT 50""".replace(") WHERE", ") s WHERE"),
    ),
)
def literal_top(spark, sf_dir):
    return anomaly.top_anomalies(flagged(spark, sf_dir))


# The panel of the event stream's closed days, with the features that alerts are made from.
_CLOSED_PANEL = f""", short_days AS (SELECT *,
      coalesce((price - province_mean) / nullif(province_mean, 0) * 100, 0) AS deviation_pct,
      coalesce((price - previous_price) / nullif(previous_price, 0) * 100, 0) AS delta_pct
    FROM (SELECT *, avg(price) OVER (PARTITION BY commodity, obs_date) AS province_mean,
        lag(price) OVER (PARTITION BY region, commodity ORDER BY obs_date) AS previous_price
      FROM (SELECT cast(ts AS date) AS obs_date, 'R' || (user_id % 15) AS region, event_type AS commodity,
          avg(value) AS price, {", ".join(f"0.0 AS {c}" for c in WEATHER)} FROM events GROUP BY 1, 2, 3
        HAVING cast(ts AS date) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events))
      JOIN (SELECT obs_date, {", ".join(CALENDAR)} FROM event_calendar) USING (obs_date))) """


def _alerts_sql(trees: list) -> str:
    return f""" SELECT obs_date, region, commodity, round(price, 6) AS price, round(deviation_pct, 6) AS deviation_pct,
        round(delta_pct, 6) AS delta_pct, round(score, 6) AS score
      FROM ({_scored_sql("short_days", trees)}) WHERE is_anom = 1"""


def _closed_alerts(spark: SparkSession, sf_dir: str, forest: Forest | None, models: ModelStore | None) -> DataFrame:
    rows = feed.with_calendar(feed.ingest(event_feed(spark, sf_dir)), event_calendar(spark, sf_dir))
    root = scratch_path(spark, "literal-alerts")
    progress = scratch_path(spark, "literal-progress")
    alerts.start_alerts(rows, forest, THRESHOLD, root, progress, models=models).awaitTermination()
    found = alerts.read_alerts(spark, root)
    shown = ["price", "deviation_pct", "delta_pct", "score"]
    return rounded(found.select("obs_date", *ENTITY, *shown), *shown)


@query("st6_literal_alerts", over("event_calendar", _CLOSED_PANEL + _alerts_sql(TREES)))
def literal_alerts(spark, sf_dir):
    """Alerts of all closed days under the literal forest."""
    return _closed_alerts(spark, sf_dir, literal_forest(), None)


@query("st6_published_alerts", over("event_calendar", _CLOSED_PANEL + _alerts_sql(_SECOND)))
def published_alerts(spark, sf_dir):
    """The same stream, served by the newest of two published forests."""
    models = ModelStore(scratch_path(spark, "models"))
    models.publish(spark, literal_forest(), THRESHOLD)
    models.publish(spark, literal_forest(_SECOND), THRESHOLD)
    return _closed_alerts(spark, sf_dir, None, models)


@query("st6_keyed_alerts", over("event_calendar", _CLOSED_PANEL + _alerts_sql(TREES)))
def keyed_alerts(spark, sf_dir):
    """The same alerts with the last prices in the state store."""
    rows = feed.with_calendar(feed.ingest(event_feed(spark, sf_dir)), event_calendar(spark, sf_dir))
    root, progress = scratch_path(spark, "keyed-alerts"), scratch_path(spark, "keyed-progress")
    keyed.start_keyed_alerts(spark, rows, literal_forest(), THRESHOLD, root, progress).awaitTermination()
    shown = ["price", "deviation_pct", "delta_pct", "score"]
    return rounded(alerts.read_alerts(spark, root).select("obs_date", *ENTITY, *shown), *shown)


_EVENT_ROWS = """SELECT cast(ts AS date) AS obs_date, 'R' || (user_id % 15) AS region,
    cast(user_id % 15 AS int) AS region_id, event_type AS commodity, value AS price FROM events"""


@query("s07_message_log", _EVENT_ROWS + " WHERE value IS NOT NULL")
def message_log(spark, sf_dir):
    """The events as JSON messages in log files, read by byte offsets."""
    events = table(spark, sf_dir, "events")
    region_id = (F.col("user_id") % 15).cast("int")
    record = F.struct(
        F.col("ts").cast("date").cast("string").alias("obs_date"),
        F.concat(F.lit("R"), region_id.cast("string")).alias("region"),
        region_id.alias("region_id"),
        F.col("event_type").alias("commodity"),
        F.col("value").alias(PRICE),
    )
    path = scratch_path(spark, "message-log").removeprefix("file:")
    events.select(F.to_json(record)).write.text(path)
    rows = feed.read_feed(spark, path, "message_log", PANEL_SCHEMA, partBytes=1 << 20)
    return feed.drained(feed.ingest(rows).select("obs_date", "region", "region_id", "commodity", PRICE), "log")


@query("st2_two_stage_replays", "SELECT event_id, event_type AS commodity FROM events")
def two_stage_replays(spark, sf_dir):
    """Every event three times; the copies meet by source task first and by key then."""
    thrice = event_feed(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("_copy")
    rows = feed.drop_replays(feed.ingest(thrice, "60 days"), ["event_id"], parts=16)
    return feed.drained(rows.select("event_id", "commodity"), "two-stage")


_CORRECTED = "obs_date BETWEEN date '1997-03-10' AND date '1997-04-20' AND region_id % 2 = 0"


@query(
    "s06_history_correction",
    over(
        "panel",
        f" SELECT {PANEL_LIST} FROM (SELECT * REPLACE (CASE WHEN {_CORRECTED} THEN price + 1.5 ELSE price END AS price) FROM panel)",
    ),
)
def history_correction(spark, sf_dir):
    """Late prices of some weeks replace the stored ones."""
    path = scratch_path(spark, "history")
    files.write_history(panel(spark, sf_dir), path)
    files.correct_history(panel(spark, sf_dir).where(_CORRECTED).withColumn(PRICE, F.col(PRICE) + 1.5), path)
    return files.read_history(spark, path)


@query(
    "f10_movable_feast",
    """WITH years AS (SELECT y, y % 30 IN (2, 5, 7, 10, 13, 16, 18, 21, 24, 26, 29) AS leap FROM range(1300, 1501) t(y)),
      feasts AS (SELECT y, date '2024-04-10' + cast(coalesce(sum(354 + leap::int) OVER (ORDER BY y ROWS BETWEEN
          UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - (SELECT sum(354 + leap::int) FROM years WHERE y < 1445) AS int) AS feast
        FROM years),
      days AS (SELECT DISTINCT o_orderdate::date AS obs_date FROM orders)
    SELECT obs_date, cast(min(abs(obs_date - feast)) AS int) AS days_to_eid FROM days, feasts GROUP BY 1""",
)
def movable_feast(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("obs_date")).distinct()
    return days.select("obs_date", days_to_feast("obs_date").alias("days_to_eid"))


@query(
    "a14_sketch_quantile",
    over("panel", " SELECT commodity, count(*) AS n, true AS near FROM panel WHERE price IS NOT NULL GROUP BY 1"),
)
def sketch_quantiles(spark, sf_dir):
    """Medians by commodity from sketches of parts of the panel; their true ranks are near one half."""
    rows = panel(spark, sf_dir)
    parts = sketch.value_sketch(rows, PRICE, ["commodity", "region"])
    found = sketch.sketch_quantile(sketch.merged_sketch(parts, ["commodity"]), 0.5, "median")
    joined = rows.join(found.select("commodity", "median"), "commodity")
    ranks = joined.groupBy("commodity").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(PRICE) < F.col("median")).cast("int")).alias("below"),
        F.avg((F.col(PRICE) <= F.col("median")).cast("int")).alias("up_to"),
    )
    near = (F.col("below") <= 0.5 + sketch.RANK_ERROR) & (F.col("up_to") >= 0.5 - sketch.RANK_ERROR)
    return ranks.select("commodity", "n", near.alias("near"))

