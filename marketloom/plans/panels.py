"""Price panels made from the given star-schema tables.

Values are whole numbers, so sums do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions.calendar import build_calendar
from marketloom.operators.integrate import with_calendar
from marketloom.schema import PANEL_COLUMNS, WEATHER

_kept: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(spark: SparkSession, sf_dir: str, name: str, df: DataFrame) -> DataFrame:
    """`df` cached for the session under a name, built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = df.persist(StorageLevel.MEMORY_AND_DISK)
    return _kept[key]


def _cents(column: str):
    """Sum in hundredths as whole numbers: exact in any order, without decimals."""
    return F.sum(F.round(F.col(column) * 100).cast("bigint"))


def _whole(dividend, divisor):
    """Largest whole number below the quotient."""
    part = F.pmod(dividend, divisor)
    return F.call_function("div", dividend - part, divisor).cast("double")


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit prices per ship date, supplier nation and part type, with three
    more sums in the place of weather."""
    items = table(spark, sf_dir, "lineitem")
    joined = (
        items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy(
        F.col("l_shipdate").cast("date").alias("obs_date"),
        F.col("n_name").alias("region"),
        F.col("s_nationkey").alias("region_id"),
        F.col("p_type").alias("commodity"),
    ).agg(
        _whole(_cents("l_extendedprice"), _cents("l_quantity")).alias("price"),
        _whole(_cents("l_quantity"), F.count(F.lit(1)) * 100).alias("temp_avg_c"),
        _cents("l_discount").cast("double").alias("rain_mm"),
        _cents("l_tax").cast("double").alias("humidity_avg_pct"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event values per day, type and user group; thirty days, no weather."""
    group = (F.col("user_id") % 15).cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("ts").cast("date").alias("obs_date"),
            group.alias("region_id"),
            F.col("event_type").alias("commodity"),
        )
        .agg(_whole(_cents("value"), F.count(F.lit(1)) * 100).alias("price"))
        .withColumn("region", F.concat(F.lit("R"), F.col("region_id").cast("string")))
        .withColumns({c: F.lit(None).cast("double") for c in WEATHER})
    )


def feast_days(dates: DataFrame) -> DataFrame:
    """A movable feast for the years around the dates, one a year."""
    years = dates.select(
        F.explode(F.array(*[F.year("obs_date") + s for s in (-1, 0, 1)])).alias("y")
    ).distinct()
    return years.select(F.make_date("y", F.col("y") % 12 + 1, F.lit(15)).alias("feast_date"))


def holiday_days(feasts: DataFrame) -> DataFrame:
    """Feast days, December 25 and January 1 of the same years."""
    year = F.year("feast_date")
    days = F.array(
        "feast_date",
        F.make_date(year, F.lit(12), F.lit(25)),
        F.make_date(year, F.lit(1), F.lit(1)),
    )
    return feasts.select(F.explode(days).alias("holiday_date")).distinct()


def calendar_of(rows: DataFrame) -> DataFrame:
    dates = rows.select("obs_date").distinct()
    feasts = feast_days(dates)
    return build_calendar(dates, feasts, holiday_days(feasts))


def price_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(spark, sf_dir, "prices", price_rows(spark, sf_dir))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(spark, sf_dir, "calendar", calendar_of(price_parts(spark, sf_dir)))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long panel: years of days, every series fit for the model."""
    key = (spark.sparkContext.applicationId, sf_dir, "panel")
    if key not in _kept:
        joined = with_calendar(price_parts(spark, sf_dir), calendar(spark, sf_dir))
        keep(spark, sf_dir, "panel", joined.select(*PANEL_COLUMNS))
    return _kept[key]


def short_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short panel: thirty days, every series too short for the model."""
    key = (spark.sparkContext.applicationId, sf_dir, "short")
    if key not in _kept:
        rows = event_rows(spark, sf_dir)
        keep(
            spark, sf_dir, "short", with_calendar(rows, calendar_of(rows)).select(*PANEL_COLUMNS)
        )
    return _kept[key]
