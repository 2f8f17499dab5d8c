import os

import duckdb
import pytest

import __spark_entry__ as spec
from marketloom.operators import anomaly, series
from marketloom.plans import catalog, panels
from tools.check_queries import TABLES, compare, type_difference

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_same_rows_as_sql(spark, db, name):
    frame = spec.queries()[name](spark, SF)
    relation = db.sql(spec.oracle_sql()[name])
    assert compare(frame.toPandas(), relation.df()) == ""
    assert type_difference(frame, relation) == ""


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows_come_out(spark, name):
    assert spec.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    rows = spec.entry(spark)
    assert rows.count() == 6 * 7


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_series_windows_are_partitioned(spark):
    plan = executed(series.forecast_features(catalog.daily(spark, SF)))
    assert "SinglePartition" not in plan and "hashpartitioning(commodity" in plan


def test_no_query_joins_all_pairs(spark):
    for df in (
        anomaly.anomaly_features(panels.panel(spark, SF)),
        panels.calendar_of(panels.price_rows(spark, SF)),
        catalog.all_forecasts(spark, SF),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lineitem_scan_reads_only_what_it_needs(spark):
    plan = executed(panels.price_rows(spark, SF))
    schema = next(line for line in plan.splitlines() if "l_shipdate" in line and "ReadSchema" in line)
    assert "l_returnflag" not in schema and "l_orderkey" not in schema
    assert "IsNotNull(l_partkey)" in schema


def test_calendar_is_broadcast(spark):
    assert "BroadcastHashJoin" in executed(catalog.calendar_integration(spark, SF))
