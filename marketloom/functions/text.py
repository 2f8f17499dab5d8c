"""Display text for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.schema import CRITICAL_SCORE
from marketloom.functions.numeric import _col

# Labels of the report.
NO_VALUE = "-"
YES = "Ya"
NO = "-"
CURRENCY = "Rp "


def number_text(x, prefix: str = "") -> Column:
    """1234567.5 -> 1.234.567,5 (dots between thousands, decimal comma)."""
    shown = F.call_function("format_number", _col(x), F.lit("#,##0.###"))
    swapped = F.translate(shown, ",.", ".,")
    return F.coalesce(F.concat(F.lit(prefix), swapped), F.lit(prefix + NO_VALUE))


def money_text(x) -> Column:
    return number_text(x, CURRENCY)


def percent_text(x) -> Column:
    """One decimal and a percent sign."""
    x = _col(x)
    return F.when(x.isNull(), F.lit(NO_VALUE)).otherwise(
        F.format_string("%.1f%%", x.cast("double"))
    )


def signed_percent_text(x) -> Column:
    """+5%, -2.5%: a sign on non-negative values, no trailing zero."""
    x = _col(x)
    digits = F.regexp_replace(x.cast("decimal(24,1)").cast("string"), r"\.0$", "")
    sign = F.when(x >= 0, F.lit("+")).otherwise(F.lit(""))
    return F.concat(sign, digits, F.lit("%"))


def flag_text(flag) -> Column:
    return F.when(_col(flag) != 0, F.lit(YES)).otherwise(F.lit(NO))


def iso_date_text(day) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def severity(score, threshold: float = CRITICAL_SCORE) -> Column:
    return F.when(_col(score) < threshold, F.lit("critical")).otherwise(F.lit("normal"))


def accuracy_band(mape) -> Column:
    """Below 10 % accurate, up to 20 % fair, poor above."""
    mape = _col(mape)
    return (
        F.when(mape < 10, F.lit("accurate"))
        .when(mape <= 20, F.lit("fair"))
        .when(mape > 20, F.lit("poor"))
    )


def json_record(*columns) -> Column:
    """The columns as one JSON object that keeps its NULL fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
