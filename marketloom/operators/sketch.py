"""Quantiles that can be kept up to date: mergeable KLL sketches.

A sketch has a bounded size whatever it has seen. With SKETCH_K the rank of an
answer is off by less than RANK_ERROR of all values, with a confidence of 99 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.scratch import remove
from marketloom.streaming.models import stored

SKETCH_K = 4096
RANK_ERROR = 0.001


def value_sketch(rows: DataFrame, column: str, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """One `sketch` of a column per group, combined on the map side; NULL and NaN are not counted."""
    known = rows.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("sketch"))


def merged_sketch(sketches: DataFrame, keys: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches of parts of the values as one sketch per group."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantile(sketches: DataFrame, q: float, name: str = "quantile") -> DataFrame:
    """The quantile of each sketch, and how many values it has seen."""
    return sketches.where("sketch is not null").select(
        *[c for c in sketches.columns if c != "sketch"],
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(name),
        F.kll_sketch_get_n_double("sketch").alias("n"),
    )


class RunningQuantile:
    """The quantile of a column over all batches of a stream, for use in `foreachBatch`.

    `root/batch_id=N` holds the sketch after batch N, made from that after batch
    N - 1, so a batch that is run again writes the same state again.
    """

    def __init__(self, root: str, column: str, q: float):
        self.root, self.column, self.q = root.rstrip("/"), column, q

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sketches = value_sketch(batch, self.column)
        before = stored(spark, f"{self.root}/batch_id={batch_id - 1}")
        if before is not None:
            sketches = sketches.union(before)
        known = merged_sketch(sketches.where("sketch is not null"))
        known.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")
        remove(spark, f"{self.root}/batch_id={batch_id - 2}")

    def value(self, spark, batch_id: int) -> float | None:
        """The quantile after a batch; None before the first value."""
        state = stored(spark, f"{self.root}/batch_id={batch_id}")
        row = None if state is None else sketch_quantile(state, self.q).first()
        return None if row is None else row["quantile"]
