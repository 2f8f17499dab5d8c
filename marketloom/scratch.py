"""Where intermediate tables go: the shared folder the session names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; its warehouse only for a local master."""
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that nothing has used yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, root: str | None = None, **options: str) -> DataFrame:
    """The same rows read back from Parquet: cuts lineage and outlives executors; `options` are the writer's."""
    spark = df.sparkSession
    path = scratch_path(spark, name) if root is None else f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[Callable[..., DataFrame]]:
    """A `written` whose tables are removed at the end of the block."""
    root = scratch_path(spark, name)
    try:
        yield lambda df, table, **options: written(df, table, root, **options)
    finally:
        remove(spark, root)
