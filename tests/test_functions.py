import pytest
from pyspark.sql import functions as F

from marketloom.functions import numeric, text


def values(spark, column, data, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_safe_int_rounds_to_even_and_maps_the_rest_to_zero(spark):
    data = [2.5, 3.5, -2.5, 2.4, None, float("nan"), float("inf"), float("-inf")]
    assert values(spark, numeric.safe_int("x"), data) == [2, 4, -2, 2, 0, 0, 0, 0]


def test_round_even(spark):
    assert values(spark, numeric.round_even("x", 2), [0.125, 0.135]) == [0.12, 0.14]


def test_to_number(spark):
    data = ["1.5", "x", None, "NaN", " 7 "]
    assert values(spark, numeric.to_number("x"), data, "string") == [1.5, 0, 0, 0, 7]


def test_pct_change_without_base_is_zero(spark):
    df = spark.createDataFrame(
        [(0, 5.0, 0.0), (1, 5.0, None), (2, 5.0, 4.0), (3, 5.0, float("nan"))],
        "i int, v double, b double",
    )
    got = [r.p for r in df.select("i", numeric.pct_change("v", "b").alias("p")).orderBy("i").collect()]
    assert got == [0, 0, 25, 0]


def test_min_max_scale_of_a_constant_is_zero(spark):
    low, high = F.lit(4.0), F.lit(4.0)
    assert values(spark, numeric.min_max_scale("x", low, high), [4.0, 9.0]) == [0, 0]


@pytest.mark.parametrize(
    "make, data, shown",
    [
        (text.number_text, [1234567.0, 1234.5, 0.0, None], ["1.234.567", "1.234,5", "0", "-"]),
        (text.money_text, [12000.0, None], ["Rp 12.000", "Rp -"]),
        (text.percent_text, [2.25, 10.0, None], ["2.3%", "10.0%", "-"]),
        (text.signed_percent_text, [5.0, -2.5, 0.0, 12345678.9], ["+5%", "-2.5%", "+0%", "+12345678.9%"]),
        (text.flag_text, [1.0, 0.0], ["Ya", "-"]),
        (text.accuracy_band, [9.99, 10.0, 20.0, 20.01], ["accurate", "fair", "fair", "poor"]),
        (text.severity, [-0.06, -0.05, 0.0], ["critical", "normal", "normal"]),
    ],
)
def test_display_text(spark, make, data, shown):
    assert values(spark, make("x"), data) == shown


def test_json_record_keeps_nulls(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b")
    assert df.select(text.json_record("a", "b")).first()[0] == '{"a":1,"b":null}'
