"""Result tables on disk, under the version of the code that made them."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.schema import RESULT_VERSION


class ResultStore:
    """Tables of finished batch runs under `root/version=N/`.

    A run writes into a folder of its own and is listed only when all of its
    tables are there, so a broken run is never read and a new one never
    disturbs readers.
    """

    def __init__(self, spark: SparkSession, root: str, version: int = RESULT_VERSION):
        self.spark = spark
        self.base = f"{root.rstrip('/')}/version={version}"

    def new_run(self) -> str:
        return uuid.uuid4().hex

    def write(self, run: str, name: str, table: DataFrame) -> DataFrame:
        path = self._path(run, name)
        table.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def finish(self, run: str, tables: list[str]) -> None:
        listed = self.spark.createDataFrame([(run, tables)], "run string, tables array<string>")
        listed.withColumn("finished_at", F.current_timestamp()).write.mode("append").parquet(
            f"{self.base}/finished"
        )

    def latest(self) -> tuple[str, list[str]] | None:
        """(run, table names) of the last finished run of this version."""
        try:
            finished = self.spark.read.parquet(f"{self.base}/finished")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return None
        row = finished.orderBy(F.desc("finished_at"), "run").first()
        return (row["run"], list(row["tables"])) if row else None

    def read(self, run: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(run, name))

    def _path(self, run: str, name: str) -> str:
        return f"{self.base}/run={run}/{name}"
