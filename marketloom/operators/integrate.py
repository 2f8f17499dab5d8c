"""Price, weather and calendar feeds joined into one panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketloom.functions.numeric import is_missing
from marketloom.schema import CALENDAR, PANEL_COLUMNS, PRICE, WEATHER


def valid_rows(panel: DataFrame) -> DataFrame:
    """Rows with a price: neither NULL nor NaN."""
    return panel.where(~is_missing(PRICE))


def with_weather(prices: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily weather of the row's region; prices without weather are kept."""
    return prices.join(
        weather.select("obs_date", "region", *WEATHER), ["obs_date", "region"], "left"
    )


def with_calendar(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar columns of the row's date.

    A calendar is short, so adaptive execution broadcasts it by its real size.
    """
    return prices.join(calendar.select("obs_date", *CALENDAR), "obs_date", "left")


def integrate(prices: DataFrame, weather: DataFrame, calendar: DataFrame) -> DataFrame:
    """The full panel from its three feeds."""
    return with_calendar(with_weather(prices, weather), calendar).select(*PANEL_COLUMNS)


def select_distinct_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns, each once, at its first place."""
    return df.select(*dict.fromkeys(columns))
