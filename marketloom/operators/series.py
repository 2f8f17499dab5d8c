"""Daily series per commodity and their window features.

A series has one row per date, so a window over one commodity is never longer
than the calendar, however many rows of the panel that commodity holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketloom.functions.numeric import is_missing, min_max_scale
from marketloom.schema import (
    AVERAGE_DAYS,
    BACKTEST_DAYS,
    CALENDAR,
    HISTORY_DAYS,
    HORIZON,
    MIN_SAMPLES,
    MODEL_INPUTS,
    PRICE,
    SEQUENCE_DAYS,
    SERIES_DAY,
    TEST_RATIO,
    WEATHER,
)


def by_day() -> WindowSpec:
    return Window.partitionBy("commodity").orderBy("obs_date")


def newest_first() -> WindowSpec:
    return Window.partitionBy("commodity").orderBy(F.desc("obs_date"))


def whole_series() -> WindowSpec:
    return Window.partitionBy("commodity")


def daily_series(panel: DataFrame, commodity: str | None = None) -> DataFrame:
    """Mean price and weather over the regions, for every commodity and date.

    Calendar columns depend on the date alone; their minimum is that value
    whatever order rows arrive in.
    """
    if commodity is not None:
        panel = panel.where(F.col("commodity") == commodity)
    return panel.groupBy(*SERIES_DAY).agg(
        *[F.avg(c).alias(c) for c in (PRICE, *WEATHER)],
        *[F.min(c).alias(c) for c in CALENDAR],
    )


def spread_series(daily: DataFrame) -> DataFrame:
    """Series dealt out to the session's number of shuffle partitions.

    All later steps work per series and stay in these partitions. A fixed
    number keeps adaptive execution from packing few but costly series into
    one task.
    """
    n = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return daily.repartition(n, "commodity")


def price_lags(offsets: Sequence[int] = (1, 7, 14, 30)) -> dict[str, Column]:
    return {f"lag_{k}": F.lag(PRICE, k).over(by_day()) for k in offsets}


def rolling_means(lengths: Sequence[int] = (7, 30)) -> dict[str, Column]:
    """Mean of the rows before the current one."""
    return {f"rolling_{n}": F.avg(PRICE).over(by_day().rowsBetween(-n, -1)) for n in lengths}


def price_trends(offsets: Sequence[int] = (1, 7)) -> dict[str, Column]:
    return {f"trend_{k}": F.col(PRICE) - F.lag(PRICE, k).over(by_day()) for k in offsets}


def row_numbers() -> dict[str, Column]:
    return {"row_num": F.row_number().over(by_day()).cast("bigint")}


def lead_labels(horizon: int = HORIZON) -> dict[str, Column]:
    return {f"label_h{h}": F.lead(PRICE, h).over(by_day()) for h in range(1, horizon + 1)}


def forecast_features(daily: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Lags, rolling means, trends, row number and lead labels in one pass."""
    return daily.withColumns(
        {
            **price_lags(),
            **rolling_means(),
            **price_trends(),
            **row_numbers(),
            **lead_labels(horizon),
        }
    )


def fill_gaps(daily: DataFrame, columns: Sequence[str] = MODEL_INPUTS) -> DataFrame:
    """Last known value; before the first known value, that value."""
    so_far = by_day().rowsBetween(Window.unboundedPreceding, 0)
    series = by_day().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = {}
    for name in columns:
        known = F.when(~is_missing(F.col(name).cast("double")), F.col(name))
        filled[name] = F.coalesce(
            F.last(known, ignorenulls=True).over(so_far),
            F.first(known, ignorenulls=True).over(series),
        )
    return daily.withColumns(filled)


def input_sequences(daily: DataFrame, days: int = SEQUENCE_DAYS) -> DataFrame:
    """The `days` rows before each row as an array of structs, complete ones only."""
    before = by_day().rowsBetween(-days, -1)
    sequence = F.collect_list(F.struct(*MODEL_INPUTS)).over(before)
    return daily.select(*SERIES_DAY, sequence.alias("inputs")).where(F.size("inputs") == days)


def target_vectors(
    daily: DataFrame, days: int = SEQUENCE_DAYS, horizon: int = HORIZON
) -> DataFrame:
    """The next `horizon` prices from each row on that has a full input sequence."""
    ahead = by_day().rowsBetween(0, horizon - 1)
    return (
        daily.select(
            *SERIES_DAY,
            F.row_number().over(by_day()).alias("_n"),
            F.collect_list(PRICE).over(ahead).alias("targets"),
        )
        .where((F.col("_n") > days) & (F.size("targets") == horizon))
        .drop("_n")
    )


def series_size(
    daily: DataFrame, days: int = SEQUENCE_DAYS, horizon: int = HORIZON
) -> DataFrame:
    """Days and usable training samples of each series."""
    n_samples = F.greatest(F.col("n_days") - (days + horizon - 1), F.lit(0).cast("bigint"))
    return (
        daily.groupBy("commodity")
        .agg(F.count(F.lit(1)).alias("n_days"))
        .withColumn("n_samples", n_samples)
    )


def train_sample_count(n_samples: Column, test_ratio: float = TEST_RATIO) -> Column:
    """Samples used for fitting: at least one, and one is left to test."""
    share = F.floor(n_samples * F.lit(1 - test_ratio)).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), F.least(share, n_samples - 1))


def chronological_split(
    daily: DataFrame,
    days: int = SEQUENCE_DAYS,
    horizon: int = HORIZON,
    test_ratio: float = TEST_RATIO,
) -> DataFrame:
    """Training samples by the date of their first target, marked train or test."""
    numbered = daily.select(
        *SERIES_DAY,
        (F.row_number().over(by_day()).cast("bigint") - days).alias("sample"),
        F.count(F.lit(1)).over(whole_series()).alias("_n_days"),
    )
    n_samples = F.col("_n_days") - (days + horizon - 1)
    part = F.when(F.col("sample") <= train_sample_count(n_samples, test_ratio), "train")
    return numbered.where((F.col("sample") >= 1) & (F.col("sample") <= n_samples)).select(
        *SERIES_DAY, "sample", part.otherwise("test").alias("part")
    )


def train_rows(
    daily: DataFrame,
    days: int = SEQUENCE_DAYS,
    horizon: int = HORIZON,
    test_ratio: float = TEST_RATIO,
) -> DataFrame:
    """Rows before the first test target; the rest is unseen while fitting."""
    numbered = daily.withColumns(
        {
            "_n": F.row_number().over(by_day()).cast("bigint"),
            "_n_days": F.count(F.lit(1)).over(whole_series()),
        }
    )
    n_samples = F.col("_n_days") - (days + horizon - 1)
    seen = F.when(n_samples >= 1, days + train_sample_count(n_samples, test_ratio))
    return numbered.where(F.col("_n") <= F.coalesce(seen, F.col("_n_days"))).drop("_n", "_n_days")


def scaling_statistics(
    rows: DataFrame, columns: Sequence[str] = MODEL_INPUTS
) -> DataFrame:
    """Least and greatest value of each column in each series."""
    return rows.groupBy("commodity").agg(
        *[F.min(c).alias(f"{c}_min") for c in columns],
        *[F.max(c).alias(f"{c}_max") for c in columns],
    )


def scale_series(
    daily: DataFrame, statistics: DataFrame, columns: Sequence[str] = MODEL_INPUTS
) -> DataFrame:
    """Columns moved to 0..1 by the statistics of their series."""
    scaled = {c: min_max_scale(c, f"{c}_min", f"{c}_max") for c in columns}
    return daily.join(statistics, "commodity").select(
        *SERIES_DAY, *[scaled[c].alias(c) for c in columns]
    )


def history_tail(daily: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """The last `days` rows of every series."""
    numbered = daily.select(
        *SERIES_DAY, PRICE, F.row_number().over(newest_first()).alias("_back")
    )
    return numbered.where(F.col("_back") <= days).drop("_back")


def last_values(daily: DataFrame) -> DataFrame:
    """Last date of every series and the price on it."""
    return daily.groupBy("commodity").agg(
        F.max("obs_date").alias("last_date"),
        F.max_by(PRICE, "obs_date").alias("last_price"),
    )


def naive_backtest(daily: DataFrame, days: int = BACKTEST_DAYS) -> DataFrame:
    """Last `days` rows, each predicted by the row before it."""
    numbered = daily.select(
        *SERIES_DAY,
        F.col(PRICE).alias("actual"),
        F.lead(PRICE).over(newest_first()).alias("prediction"),
        F.lead("obs_date").over(newest_first()).alias("_before"),
        F.row_number().over(newest_first()).alias("_back"),
    )
    return numbered.where((F.col("_back") <= days) & F.col("_before").isNotNull()).drop(
        "_before", "_back"
    )


def moving_average(daily: DataFrame, days: int = AVERAGE_DAYS) -> DataFrame:
    """Mean price of the last `days` rows of every series."""
    return history_tail(daily, days).groupBy("commodity").agg(F.avg(PRICE).alias("mean_price"))


def _path(n_days: Column, complete: Column, days: int, horizon: int) -> Column:
    ready = (
        (n_days > days + horizon + BACKTEST_DAYS)
        & (n_days - (days + horizon - 1) >= MIN_SAMPLES)
        & complete
    )
    return F.when(ready, "model").otherwise("baseline")


def _has_all_inputs() -> list[Column]:
    """Per model input, 1 in the rows that know it."""
    return [(~is_missing(F.col(c).cast("double"))).cast("int") for c in MODEL_INPUTS]


def series_path(
    daily: DataFrame, days: int = SEQUENCE_DAYS, horizon: int = HORIZON
) -> DataFrame:
    """Which forecast a series gets: `model` or `baseline`.

    The model needs enough days, enough samples and at least one known value
    in each of its inputs.
    """
    known = F.least(*[F.max(flag) for flag in _has_all_inputs()])
    sized = daily.groupBy("commodity").agg(
        F.count(F.lit(1)).alias("n_days"), (known == 1).alias("_complete")
    )
    path = _path(F.col("n_days"), F.col("_complete"), days, horizon)
    return sized.select("commodity", "n_days", path.alias("path"))


def with_series_path(
    daily: DataFrame, days: int = SEQUENCE_DAYS, horizon: int = HORIZON
) -> DataFrame:
    """Every day with the path of its series, without a join."""
    series = whole_series()
    known = F.least(*[F.max(flag).over(series) for flag in _has_all_inputs()])
    n_days = F.count(F.lit(1)).over(series)
    return daily.withColumn("path", _path(n_days, known == 1, days, horizon))
