"""Versions of the alert model: training publishes one, the stream takes the newest at each batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.forest import Forest


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


class ModelStore:
    """Forests and their thresholds under `root/version=N`; a version never changes."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self._loaded: dict[int, tuple[Forest, float]] = {}

    def publish(self, spark: SparkSession, forest: Forest, threshold: float) -> int:
        """Store a model as the next version; the stream takes it from its next batch on."""
        version = (self.newest(spark) or 0) + 1
        table = forest.node_table(spark).withColumn("alert_threshold", F.lit(float(threshold)))
        table.coalesce(1).write.parquet(f"{self.root}/version={version}")
        return version

    def newest(self, spark: SparkSession) -> int | None:
        found = stored(spark, self.root)
        return None if found is None else found.agg(F.max("version")).first()[0]

    def load(self, spark: SparkSession, version: int) -> tuple[Forest, float]:
        """A version's forest and threshold; the last one asked for is kept."""
        if version not in self._loaded:
            table = spark.read.parquet(f"{self.root}/version={version}")
            threshold = table.select("alert_threshold").first()[0]
            self._loaded = {version: (Forest.from_node_table(table.drop("alert_threshold")), threshold)}
        return self._loaded[version]
