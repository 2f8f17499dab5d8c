"""Price deviations per row, flags and the anomaly report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.numeric import pct_change, round_even, safe_int, to_number
from marketloom.operators.quantile import exact_quantile
from marketloom.operators.skew import attach, collapse_copies, content_hash, copies_of, expand_copies
from marketloom.schema import (
    ANOMALY_FEATURES,
    ANOMALY_RATE,
    ENTITY,
    PRICE,
    SERIES_DAY,
    TOP_ANOMALIES,
)

# Parts that one day of a (region, commodity) is cut into.
_DAY_PARTS = 1024
REPORT_KEYS = ["obs_date", "region", "commodity"]


def province_means(panel: DataFrame) -> DataFrame:
    """Mean price of all regions per commodity and date, combined on the map side."""
    return panel.groupBy(*SERIES_DAY).agg(F.avg(PRICE).alias("province_mean"))


def with_province_mean(panel: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """`rows` (the panel itself by default) next to the panel's province means.

    Joining the means back leaves no task with all rows of one commodity and
    date; adaptive execution broadcasts them if they turn out small and splits
    a partition with too many rows if not. For that both sides of the join need
    a shuffle of their own.
    """
    return attach(panel if rows is None else rows, province_means(panel), SERIES_DAY)


def _with_tie(rows: DataFrame) -> DataFrame:
    """Order of rows that share region, commodity and date: by their content."""
    content = [c for c in rows.columns if c != "copies"]
    return rows.withColumn("_tie", content_hash(content)).withColumn(
        "_part", F.pmod("_tie", F.lit(_DAY_PARTS))
    )


def with_previous_price(panel: DataFrame, compact: bool = False) -> DataFrame:
    """Price of the row before in the same region and commodity.

    Equal rows are collapsed first and a day is cut into parts by content, so
    the work is alike for every entity and no task needs a whole one: the first
    row of a part takes the last price of the part before it, and there are at
    most _DAY_PARTS of those a day to put in order. The last prices are combined
    on the map side, so the panel itself travels once for its copies and once
    for its parts. Of equal rows only the first follows another row, the others
    follow a copy of themselves.

    With `compact` equal rows stay one row, and a column `copies` says how many
    rows it stands for. Which rows those are depends on the panel's contents
    alone.
    """
    part = F.struct(*ENTITY, "obs_date", "_part").alias("_key")
    order = Window.partitionBy("_key").orderBy("_tie")
    others = [c for c in panel.columns if c not in (*ENTITY, "obs_date")]
    rows = (
        _with_tie(collapse_copies(panel))
        .select(part, *others, "copies", "_tie")
        .withColumn("_inside", F.lag(PRICE).over(order))
    )
    by_time = Window.partitionBy(*[f"_key.{c}" for c in ENTITY]).orderBy("_key.obs_date", "_key._part")
    ends = _with_tie(panel).groupBy(part).agg(F.max_by(PRICE, "_tie").alias("_end"))
    carried = ends.select("_key", F.lag("_end").over(by_time).alias("_carried"))
    before = F.coalesce("_inside", "_carried")
    first = F.struct(before.alias("price"), F.lit(1).cast("bigint").alias("n"))
    rest = F.struct(F.col(PRICE).alias("price"), (F.col("copies") - 1).alias("n"))
    alike = F.struct(F.col(PRICE).alias("price"), F.col("copies").alias("n"))
    follow = F.when(before.eqNullSafe(F.col(PRICE)), F.array(alike)).otherwise(F.array(first, rest))
    lagged = (
        rows.join(carried, "_key")
        .withColumn("_follow", F.explode(follow))
        .where(F.col("_follow.n") > 0)
        .select(
            *[c if c in others else f"_key.{c}" for c in panel.columns],
            F.col("_follow.n").alias("copies"),
            F.col("_follow.price").alias("previous_price"),
        )
    )
    return lagged if compact else expand_copies(lagged)


def anomaly_rows(panel: DataFrame, compact: bool = False) -> DataFrame:
    """Panel with deviation from the province and from the row before."""
    rows = with_province_mean(panel, with_previous_price(panel, compact))
    return rows.withColumns(
        {
            "deviation_pct": pct_change(PRICE, "province_mean"),
            "delta_pct": pct_change(PRICE, "previous_price"),
        }
    )


def anomaly_features(panel: DataFrame, compact: bool = False) -> DataFrame:
    """Keys and the ten features without gaps (and `copies` when compact)."""
    rows = anomaly_rows(panel, compact)
    features = [to_number(c).alias(c) for c in ANOMALY_FEATURES]
    return rows.select(*REPORT_KEYS, *features, *(["copies"] if compact else []))


def standardisation_statistics(features: DataFrame) -> DataFrame:
    """Mean and population deviation of each feature, one row per feature.

    The forest needs none: its splits do not change with scale.
    """
    wide = features.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in ANOMALY_FEATURES],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in ANOMALY_FEATURES],
    )
    by_name = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"mean_{c}").alias("mean"),
            F.col(f"std_{c}").alias("std"),
        )
        for c in ANOMALY_FEATURES
    ]
    return wide.select(F.inline(F.array(*by_name)))


def anomaly_threshold(scored: DataFrame, rate: float = ANOMALY_RATE) -> float | None:
    """Score below which the `rate` most unusual rows lie."""
    return exact_quantile(scored, "score", rate, copies_of(scored))


def flag_anomalies(scored: DataFrame, threshold: float | None) -> DataFrame:
    below = F.col("score") < F.lit(threshold).cast("double")
    return scored.withColumn("is_anom", F.coalesce(below.cast("int"), F.lit(0)))


def anomalous_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("is_anom") == 1)


def top_anomalies(flagged: DataFrame, n: int = TOP_ANOMALIES) -> DataFrame:
    """The `n` most unusual flagged rows, lowest score first; ties by key and price."""
    order = ["score", *REPORT_KEYS, PRICE, "deviation_pct", "delta_pct", "rain_mm", "is_holiday"]
    first = anomalous_rows(flagged).orderBy(*order).limit(n)
    repeated = first.withColumn(
        "_copy",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(copies_of(flagged), F.lit(n)))),
    )
    return (
        repeated.orderBy(*order)
        .limit(n)
        .select(
            *REPORT_KEYS,
            safe_int(PRICE).alias(PRICE),
            round_even("deviation_pct", 1).alias("deviation_pct"),
            round_even("delta_pct", 1).alias("delta_pct"),
            round_even("rain_mm", 1).alias("rain_mm"),
            F.col("is_holiday").cast("int").alias("is_holiday"),
            round_even("score", 4).alias("score"),
        )
    )


def anomaly_daily(flagged: DataFrame) -> DataFrame:
    """Flagged rows per date; dates without any count 0."""
    return (
        flagged.groupBy("obs_date")
        .agg(F.sum(F.col("is_anom") * copies_of(flagged)).alias("n_anomalies"))
        .orderBy("obs_date")
    )


def anomaly_summary(flagged: DataFrame, model: str) -> DataFrame:
    """One row: flagged rows, all rows and their ratio in percent."""
    zero = F.lit(0).cast("bigint")
    total = F.coalesce(F.sum(copies_of(flagged)), zero)
    anomalies = F.coalesce(F.sum(F.col("is_anom") * copies_of(flagged)), zero)
    share = F.coalesce(F.try_divide(anomalies, total) * 100, F.lit(0.0))
    return flagged.agg(
        anomalies.alias("total_anomalies"),
        total.alias("total_rows"),
        round_even(share, 2).alias("pct_anomalies"),
        F.lit(model).alias("model"),
    )
