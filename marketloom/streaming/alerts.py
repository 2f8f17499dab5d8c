"""Anomaly alerts for every closed day of a streaming panel."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.anomaly import anomalous_rows, anomaly_features, flag_anomalies
from marketloom.operators.forest import Forest
from marketloom.schema import ENTITY, PANEL_COLUMNS, PANEL_SCHEMA, PRICE
from marketloom.scratch import remove
from marketloom.streaming.feed import closed_days
from marketloom.streaming.models import ModelStore, stored


class AlertWriter:
    """Scores each batch of closed days and writes its alerts.

    `root/alerts/batch_id=N` holds the alerts of batch N and
    `root/latest/batch_id=N` the newest row of each (region, commodity) after
    it, also where no day was closed. Batch N starts from the latest rows of the
    batch before, so a batch that is run again writes the same files again.
    States older than that are removed.

    A day's rows that repeat a key are averaged into one (`closed_days`), where
    the batch report keeps each of them.

    With a `models` store every batch takes the newest published model when it
    begins, and `forest` and `threshold` only serve until there is one. Which
    version a batch took is kept in `root/models/batch_id=N` before it is used, so
    a batch that is run again takes the same one.
    """

    def __init__(
        self,
        root: str,
        forest: Forest | None,
        threshold: float | None,
        start: DataFrame | None = None,
        models: ModelStore | None = None,
    ):
        if forest is None and models is None:
            raise ValueError("alerts need a fitted forest; an empty panel has none")
        self.root = root.rstrip("/")
        self.models = models
        self.forest = forest
        self.threshold = threshold
        self.start = start

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = batch.select(*PANEL_COLUMNS).persist()
        try:
            first = days.agg(F.min("obs_date").alias("d")).first()["d"]
            before = self._latest_before(spark, batch_id)
            known = days
            if before is not None:
                known = days.unionByName(before if first is None else before.where(F.col("obs_date") < first))
            if first is not None:
                forest, threshold = self._model(spark, batch_id)
                scored = forest.score(anomaly_features(known)).where(F.col("obs_date") >= first)
                alerts = anomalous_rows(flag_anomalies(scored, threshold)).drop("is_anom")
                alerts.write.mode("overwrite").parquet(f"{self.root}/alerts/batch_id={batch_id}")
            newest_rows(known).write.mode("overwrite").parquet(self._state(batch_id))
            remove(spark, self._state(batch_id - 2))
        finally:
            days.unpersist()

    def _model(self, spark: SparkSession, batch_id: int) -> tuple[Forest, float | None]:
        """The model of a batch: the one it took before, else the newest one."""
        if self.models is None:
            return self.forest, self.threshold
        path = f"{self.root}/models/batch_id={batch_id}"
        taken = stored(spark, path)
        version = self.models.newest(spark) if taken is None else taken.first()["version"]
        if taken is None:
            spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").parquet(path)
        if version is not None:
            return self.models.load(spark, version)
        if self.forest is None:
            raise ValueError(f"no model has been published under {self.models.root}")
        return self.forest, self.threshold

    def _state(self, batch_id: int) -> str:
        return f"{self.root}/latest/batch_id={batch_id}"

    def _latest_before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Newest rows after the batch before; at first those of the starting panel."""
        if batch_id > 0:
            return spark.read.schema(PANEL_SCHEMA).parquet(self._state(batch_id - 1))
        return None if self.start is None else newest_rows(self.start)


def newest_rows(panel: DataFrame) -> DataFrame:
    """The last row of each (region, commodity)."""
    row = F.struct(*[c for c in PANEL_COLUMNS if c not in ENTITY])
    return (
        panel.groupBy(*ENTITY)
        .agg(F.max_by(row, F.struct("obs_date", PRICE)).alias("r"))
        .select(*ENTITY, "r.*")
        .select(*PANEL_COLUMNS)
    )


def start_alerts(
    rows: DataFrame,
    forest: Forest | None,
    threshold: float | None,
    root: str,
    checkpoint: str,
    start: DataFrame | None = None,
    models: ModelStore | None = None,
    **trigger,
):
    """Alert query over an ingested panel stream; by default over what is there now."""
    writer = AlertWriter(root, forest, threshold, start, models)
    return (
        closed_days(rows)
        .writeStream.outputMode("append")
        .foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_alerts(spark: SparkSession, root: str, like: DataFrame | None = None) -> DataFrame:
    """All alerts written so far; before the first one, no rows with the schema of `like`."""
    reader = spark.read if like is None else spark.read.schema(like.schema)
    try:
        return reader.parquet(f"{root.rstrip('/')}/alerts")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        if like is None:
            raise ValueError(f"no alerts under {root} yet; pass `like` to get an empty table") from missing
        return spark.createDataFrame([], like.schema)
