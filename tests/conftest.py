import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marketloom.schema import PANEL_COLUMNS, PANEL_SCHEMA  # noqa: E402
from panel_defaults import DEFAULTS  # noqa: E402

DAY0 = dt.date(2024, 1, 1)
@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    def make(rows):
        """Panel of dicts; `day` counts from 2024-01-01, other columns have defaults."""
        full = []
        for row in rows:
            row = {**DEFAULTS, **row}
            if "day" in row:
                row["obs_date"] = DAY0 + dt.timedelta(days=row.pop("day"))
            full.append(tuple(row[c] for c in PANEL_COLUMNS))
        return spark.createDataFrame(full, PANEL_SCHEMA)

    return make


@pytest.fixture(scope="session")
def make_series(make_panel):
    def make(prices, **fixed):
        """One region's series; prices by day, None leaves the day out."""
        return make_panel(
            [{"day": d, "price": float(p), **fixed} for d, p in enumerate(prices) if p is not None]
        )

    return make


@pytest.fixture(scope="session")
def day0():
    return DAY0
