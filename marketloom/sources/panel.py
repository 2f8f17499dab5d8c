"""Reading and writing the panel: CSV, Parquet history and cache."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.operators.integrate import valid_rows
from marketloom.schema import ENTITY, PANEL_COLUMNS, PANEL_SCHEMA, PRICE, SOURCE_HEADER
from marketloom.scratch import scratch_folder

SOURCE_SCHEMA = T.StructType(
    [
        T.StructField(name, field.dataType)
        for name, field in zip(SOURCE_HEADER, PANEL_SCHEMA.fields)
    ]
)


def to_panel_names(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[F.col(source).alias(name) for source, name in zip(SOURCE_HEADER, PANEL_COLUMNS)]
    )


def to_source_names(panel: DataFrame) -> DataFrame:
    return panel.select(
        *[F.col(name).alias(source) for source, name in zip(SOURCE_HEADER, PANEL_COLUMNS)]
    )


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows under the fixed schema, before the price gate.

    A cell that does not fit its type becomes NULL and its row stays; a header
    with other names or another order is an error.
    """
    rows = (
        spark.read.schema(SOURCE_SCHEMA)
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .csv(path)
    )
    return to_panel_names(rows)


def load_csv(spark: SparkSession, path: str) -> DataFrame:
    """The panel: scanned rows that have a price."""
    return valid_rows(scan_csv(spark, path))


def write_csv(panel: DataFrame, path: str, mode: str = "error") -> None:
    to_source_names(panel).write.mode(mode).option("header", True).option(
        "dateFormat", "yyyy-MM-dd"
    ).csv(path)


def write_history(panel: DataFrame, path: str, mode: str = "error") -> None:
    """Panel as Parquet by year and month.

    The rebalance hint gathers each month into few files and lets adaptive
    execution cut a month that is too large for one task.
    """
    dated = panel.withColumns(
        {"year": F.year("obs_date"), "file_month": F.month("obs_date")}
    )
    dated.hint("rebalance", "year", "file_month").write.mode(mode).partitionBy(
        "year", "file_month"
    ).parquet(path)


def correct_history(corrections: DataFrame, path: str) -> None:
    """Put corrected rows in place of the stored rows of their date, region and commodity.

    Rows without a stored counterpart are added; of corrections that share a key
    the one with the greatest price counts, then by the other columns. Only the
    months of the corrections are read and written anew. New months are made
    aside first and replace the old folders at the end. NULL is a key like any
    other, but a row without a date belongs to no month and is refused.
    """
    spark = corrections.sparkSession
    keys = ["obs_date", *ENTITY]
    row = F.struct(PRICE, *[c for c in PANEL_COLUMNS if c not in (*keys, PRICE)])
    new = corrections.groupBy(*keys).agg(F.max(row).alias("r")).select(*keys, "r.*").select(*PANEL_COLUMNS)
    with scratch_folder(spark, "corrections") as keep:
        new = keep(new, "rows")
        months = new.select(F.date_trunc("month", "obs_date").cast("date").alias("m")).distinct().collect()
        if any(r["m"] is None for r in months):
            raise ValueError("a correction without a date belongs to no month")
        if not months:
            return
        first, last = min(r["m"] for r in months), max(r["m"] for r in months)
        wanted = F.date_trunc("month", "obs_date").cast("date").isin([r["m"] for r in months])
        end = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        old = read_history(spark, path, str(first), str(end)).where(wanted)
        same = [old[c].eqNullSafe(new[c]) for c in keys]
        months_anew = keep(old.join(new, same, "left_anti").unionByName(new), "months")
        spread = months_anew.withColumns({"year": F.year("obs_date"), "file_month": F.month("obs_date")})
        spread.hint("rebalance", "year", "file_month").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("year", "file_month").parquet(path)


def read_history(
    spark: SparkSession, path: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Stored panel, optionally only from `first` to `last` (whole folders are skipped)."""
    rows = spark.read.schema(
        T.StructType(
            [
                *PANEL_SCHEMA.fields,
                T.StructField("year", T.IntegerType()),
                T.StructField("file_month", T.IntegerType()),
            ]
        )
    ).parquet(path)
    folder = F.col("year") * 100 + F.col("file_month")
    for bound, keep in ((first, "__ge__"), (last, "__le__")):
        if bound is not None:
            day = F.to_date(F.lit(bound))
            rows = rows.where(getattr(F.col("obs_date"), keep)(day)).where(
                getattr(folder, keep)(F.year(day) * 100 + F.month(day))
            )
    return rows.select(*PANEL_COLUMNS)


@contextmanager
def cached(panel: DataFrame):
    """The panel kept for several results and released after them.

    A panel that the caller has cached already stays as it is.
    """
    level = panel.storageLevel
    if level.useMemory or level.useDisk:
        yield panel
        return
    kept = panel.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
