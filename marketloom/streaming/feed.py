"""Streaming panel: ingest, deduplication, daily means and enrichment.

A streaming panel has an event time column `ts` besides the panel columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.integrate import valid_rows
from marketloom.schema import CALENDAR, ENTITY, PANEL_SCHEMA, PRICE, WEATHER
from marketloom.scratch import scratch_path
from marketloom.streaming.log_source import LogSource


def read_feed(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType = PANEL_SCHEMA,
    **options,
) -> DataFrame:
    """Records of a feed under a fixed schema.

    Files (`parquet`, `csv`, `json`) come from `path`. With `fmt="kafka"` each
    message value is a JSON record and `options` name servers and topic; with
    `fmt="message_log"` the messages are lines of the files in the folder `path`
    (see `log_source`).
    """
    if fmt == LogSource.name():
        spark.dataSource.register(LogSource)
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in ("kafka", LogSource.name()):
        messages = reader.load() if path is None else reader.load(path)
        record = F.from_json(F.col("value").cast("string"), schema)
        return messages.select(record.alias("record")).select("record.*")
    return reader.schema(schema).load(path)


def clock_time(wall_clock) -> Column:
    """A time without zone (or a date) as event time, read as UTC.

    Day windows start at midnight UTC, so days stay whole in any session zone.
    """
    return F.from_utc_timestamp(F.col(wall_clock).cast("timestamp"), F.current_timezone())


def window_date() -> Column:
    """The day of a one-day window."""
    return F.date_from_unix_date((F.unix_seconds("window.start") / 86400).cast("int"))


def with_event_time(rows: DataFrame) -> DataFrame:
    """Midnight of the observation date as event time."""
    return rows.withColumn("ts", clock_time("obs_date"))


def ingest(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """Rows with a price; those later than `delay` may be left out downstream."""
    timed = rows if "ts" in rows.columns else with_event_time(rows)
    return valid_rows(timed).withWatermark("ts", delay)


def drop_replays(
    rows: DataFrame, keys: Sequence[str] = ("obs_date", *ENTITY), parts: int = 1
) -> DataFrame:
    """First record of each key within the watermark delay.

    With `parts` it goes in two stages: records first meet those of their key
    from the same source task modulo `parts`, and what is left meets by key
    alone. A key that fills the feed is then compared in `parts` tasks, and at
    most `parts` of its records reach the task of the key.
    """
    if parts > 1:
        salted = rows.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
        rows = salted.dropDuplicatesWithinWatermark([*keys, "_part"]).drop("_part")
    return rows.dropDuplicatesWithinWatermark(list(keys))


def combine_replays(
    rows: DataFrame, keys: Sequence[str] = ("obs_date", *ENTITY)
) -> DataFrame:
    """Leave out repeats of a key inside each Arrow batch of the source.

    Goes before `ingest`. Records without a price go first, as `ingest` would
    drop them: they must not stand in for a repeat that has one. It needs no
    shuffle, and of a key that fills the feed only one record per batch is left
    for `drop_replays` to compare.
    """

    def first_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            repeats = batch.select(list(keys)).to_pandas().duplicated()
            yield batch.filter(pa.array(~repeats))

    return valid_rows(rows).mapInArrow(first_of_batch, rows.schema)


def daily_means(rows: DataFrame) -> DataFrame:
    """Mean price per commodity and day, given out when the day is closed."""
    return (
        rows.groupBy(F.window("ts", "1 day"), "commodity")
        .agg(F.avg(PRICE).alias(PRICE), F.count(F.lit(1)).alias("n_rows"))
        .select("commodity", window_date().alias("obs_date"), PRICE, "n_rows")
    )


def closed_days(rows: DataFrame) -> DataFrame:
    """One panel row per region, commodity and closed day.

    All rows of a day leave together, so the province mean of a day can be
    taken inside one batch.
    """
    numbers = [f.name for f in PANEL_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]
    return (
        rows.groupBy(F.window("ts", "1 day"), *ENTITY)
        .agg(
            F.min("region_id").alias("region_id"),
            *[F.avg(c).alias(c) for c in numbers],
            *[F.min(c).alias(c) for c in CALENDAR],
        )
        .withColumn("obs_date", window_date())
        .select(*PANEL_SCHEMA.fieldNames())
    )


def with_calendar(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Stream rows with the calendar columns of their date.

    Give it a stored calendar: it is read again for every batch, and a stored
    one has a known size, so that Spark broadcasts it by itself.
    """
    return rows.drop(*CALENDAR).join(calendar.select("obs_date", *CALENDAR), "obs_date", "left")


def join_live_feeds(
    prices: DataFrame, weather: DataFrame, calendar: DataFrame, delay: str = "1 day", parts: int = 8
) -> DataFrame:
    """Panel rows from a stream of prices and one of daily weather, with the calendar's columns.

    Prices and weather may come in any order within `delay`: a price leaves once
    its region and day have weather, or without weather when the day is closed
    on both streams. Of repeated weather records the first one counts; a price
    without a region has no weather. Give it feeds as `read_feed` returns them;
    `ts` of the result is the day. A region and day is cut into `parts` by
    commodity, as one region may fill the feed; weather goes to all parts.
    """
    priced = (
        valid_rows(prices.drop("ts", *WEATHER))
        .withColumns({"ts": clock_time("obs_date"), "_part": F.pmod(F.xxhash64("commodity"), F.lit(parts))})
        .withWatermark("ts", delay)
    )
    daily = (
        weather.select(clock_time("obs_date").alias("_ts"), F.col("region").alias("_region"), *WEATHER)
        .withWatermark("_ts", delay)
        .dropDuplicatesWithinWatermark(["_ts", "_region"])
        .withColumn("_in_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1))))
    )
    same = (F.col("ts") == F.col("_ts")) & (F.col("region") == F.col("_region")) & (F.col("_part") == F.col("_in_part"))
    joined = priced.join(daily, same, "left").drop("_ts", "_region", "_part", "_in_part")
    return with_calendar(joined, calendar)


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what the feed holds now into Parquet files under `path`."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def drained(stream: DataFrame, name: str) -> DataFrame:
    """Output of a stream once all present input is processed."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    run_to_end(stream, path, scratch_path(spark, f"{name}-progress"))
    return spark.read.schema(stream.schema).parquet(path)
