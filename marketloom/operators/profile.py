"""Dataset summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_info(panel: DataFrame) -> DataFrame:
    """One row: counts, distinct counts, commodity list and date range.

    Rows are first combined per (region, commodity) on the map side, so the
    distinct counts run over that short list instead of the panel. A missing
    commodity is listed but not counted.
    """
    entities = panel.groupBy("region", "commodity").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("obs_date").alias("first"),
        F.max("obs_date").alias("last"),
    )
    unnamed = F.when(
        F.max(F.col("commodity").isNull().cast("int")) == 1,
        F.array(F.lit(None).cast("string")),
    ).otherwise(F.array().cast("array<string>"))
    return entities.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total_rows"),
        F.countDistinct("region").alias("total_regions"),
        F.countDistinct("commodity").alias("total_commodities"),
        F.concat(unnamed, F.sort_array(F.collect_set("commodity"))).alias("commodities"),
        F.min("first").alias("first_date"),
        F.max("last").alias("last_date"),
    )


def row_count(panel: DataFrame) -> DataFrame:
    return panel.agg(F.count(F.lit(1)).alias("total_rows"))


def distinct_counts(panel: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of regions and commodities; exact unless told otherwise."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    rows = panel if approximate else panel.select("region", "commodity").distinct()
    return rows.agg(
        count("region").alias("total_regions"), count("commodity").alias("total_commodities")
    )


def date_range(panel: DataFrame) -> DataFrame:
    return panel.agg(
        F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date")
    )


def commodity_list(panel: DataFrame) -> DataFrame:
    """Distinct commodities in order, one per row."""
    return panel.select("commodity").distinct().orderBy("commodity")
