"""Calendar columns derived from a date and two tables of feast days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.numeric import _col


def weekday_index(day) -> Column:
    """Monday is 0."""
    return F.weekday(_col(day))


def weekend_flag(day) -> Column:
    return (F.weekday(_col(day)) >= 5).cast("int")


def days_to_christmas(day) -> Column:
    """Days to the nearest December 25, before or after."""
    day = _col(day)
    year = F.year(day)
    return F.least(
        *[
            F.abs(F.datediff(day, F.make_date(year + shift, F.lit(12), F.lit(25))))
            for shift in (-1, 0, 1)
        ]
    )


# Tabular lunar calendar, fixed values: 30 years have 10,631 days, and 1 Shawwal
# (the first day of the tenth month, the feast) of year y is this many days after
# 1970-01-01: _FEAST_DAY + 354 * (y - 1) + (3 + 11 * y) div 30.
_CYCLE_DAYS, _CYCLE_YEARS = 10_631, 30
_FIRST_DAY = -492_148
_FEAST_DAY = _FIRST_DAY + 266


def _feast_day(year: Column) -> Column:
    return _FEAST_DAY + 354 * (year - 1) + F.floor((3 + 11 * year) / 30)


def _lunar_year(day) -> Column:
    since = F.unix_date(_col(day)) - _FIRST_DAY
    return F.floor((_CYCLE_YEARS * since + 10_646) / _CYCLE_DAYS)


def feast_date(day) -> Column:
    """The movable feast of the lunar year of a day, by the tabular calendar.

    Sighting of the moon may move the feast itself by a day or two.
    """
    return F.date_from_unix_date(_feast_day(_lunar_year(day)).cast("int"))


def days_to_feast(day) -> Column:
    """Days to the nearest movable feast, before or after, without a table of feasts."""
    year = _lunar_year(day)
    return F.least(*[F.abs(F.unix_date(_col(day)) - _feast_day(year + s)) for s in (-1, 0, 1)]).cast("int")


def build_calendar(dates: DataFrame, feasts: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per distinct `obs_date` with all calendar columns.

    `feasts(feast_date)` lists the movable feast, `holidays(holiday_date)` the
    public holidays. Feasts are found by an equality join on the neighbouring
    years, so neither list has to be small.
    """
    days = dates.select("obs_date").where(F.col("obs_date").isNotNull()).distinct()
    feast_years = feasts.select("feast_date", F.year("feast_date").alias("near_year")).distinct()
    nearest = (
        days.select(
            "obs_date",
            F.explode(F.array(*[F.year("obs_date") + s for s in (-1, 0, 1)])).alias("near_year"),
        )
        .join(feast_years, "near_year", "left")
        .groupBy("obs_date")
        .agg(F.min(F.abs(F.datediff("obs_date", "feast_date"))).alias("days_to_eid"))
    )
    off = holidays.select(F.col("holiday_date").alias("obs_date"), F.lit(1).alias("_off"))
    return nearest.join(off.distinct(), "obs_date", "left").select(
        "obs_date",
        weekday_index("obs_date").alias("weekday_idx"),
        F.month("obs_date").alias("month"),
        weekend_flag("obs_date").alias("is_weekend"),
        F.coalesce("_off", F.lit(0)).alias("is_holiday"),
        "days_to_eid",
        days_to_christmas("obs_date").alias("days_to_christmas"),
    )
