"""Alerts from keyed state: the last price of every entity lives in the stream's state store.

`AlertWriter` carries the newest row of every entity from batch to batch in a
table. Here the state store holds one price per (region, commodity), so a batch
reads and writes the state of the entities that it has rows of, and of no others.
It needs the RocksDB state store provider.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from marketloom.functions.numeric import pct_change, to_number
from marketloom.operators.anomaly import REPORT_KEYS, anomalous_rows, flag_anomalies, with_province_mean
from marketloom.operators.forest import Forest
from marketloom.schema import ANOMALY_FEATURES, ENTITY, PANEL_COLUMNS, PANEL_SCHEMA, PRICE
from marketloom.streaming.alerts import newest_rows
from marketloom.streaming.feed import closed_days

# Executors need no installed package: this module travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTING = "spark.sql.streaming.stateStore.providerClass"
LAGGED_SCHEMA = T.StructType([*PANEL_SCHEMA.fields, T.StructField("previous_price", T.DoubleType())])


class LastPrice(StatefulProcessor):
    """Gives every row of an entity the price of the row before it, over all batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "price double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        days = pd.concat(list(rows)).sort_values("obs_date")
        days["previous_price"] = days["price"].shift(1)
        if self.last.exists():
            days.iloc[0, days.columns.get_loc("previous_price")] = self.last.get()[0]
        self.last.update((float(days["price"].iloc[-1]),))
        yield days

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.last.update((float(initialState["price"].iloc[0]),))

    def close(self) -> None:
        pass


def with_last_price(days: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """Rows of closed days with `previous_price`; `start` is a panel whose newest prices come before them."""
    initial = None if start is None else newest_rows(start).select(*ENTITY, PRICE).groupBy(*ENTITY)
    return (
        days.select(*PANEL_COLUMNS)
        .groupBy(*ENTITY)
        .transformWithStateInPandas(LastPrice(), LAGGED_SCHEMA, "Append", "None", initialState=initial)
    )


class KeyedAlerts:
    """Scores the rows of a batch, whose days are whole, and writes its alerts under `root/alerts/batch_id=N`."""

    def __init__(self, root: str, forest: Forest, threshold: float):
        self.root, self.forest, self.threshold = root.rstrip("/"), forest, threshold

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        days = batch.persist()
        try:
            if days.isEmpty():
                return
            rows = with_province_mean(days).withColumns(
                {"deviation_pct": pct_change(PRICE, "province_mean"), "delta_pct": pct_change(PRICE, "previous_price")}
            )
            features = rows.select(*REPORT_KEYS, *[to_number(c).alias(c) for c in ANOMALY_FEATURES])
            alerts = anomalous_rows(flag_anomalies(self.forest.score(features), self.threshold)).drop("is_anom")
            alerts.write.mode("overwrite").parquet(f"{self.root}/alerts/batch_id={batch_id}")
        finally:
            days.unpersist()


def start_keyed_alerts(
    spark: SparkSession,
    rows: DataFrame,
    forest: Forest,
    threshold: float,
    root: str,
    checkpoint: str,
    start: DataFrame | None = None,
    **trigger,
):
    """Alert query with keyed state; the session's provider setting is as before once it has started."""
    before = spark.conf.get(_SETTING)
    spark.conf.set(_SETTING, PROVIDER)
    try:
        return (
            with_last_price(closed_days(rows), start)
            .writeStream.outputMode("append")
            .foreachBatch(KeyedAlerts(root, forest, threshold))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(_SETTING, before)
