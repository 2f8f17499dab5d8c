"""Copies of one row, and joins in which NULL is a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One row stands for at most this many copies while copies are spread out.
_COPY_BLOCK = 100_000


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on `keys` where NULL equals NULL, as in a grouping; keys appear once."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(renamed[f"_right_{key}"])
    return left.join(renamed, cond, how).drop(*[f"_right_{key}" for key in keys])


def content_hash(columns: Sequence[str], *salt) -> Column:
    return F.xxhash64(*[F.lit(s) for s in salt], *[F.col(c) for c in columns])


def collapse_copies(rows: DataFrame) -> DataFrame:
    """One row per distinct content, with the number of `copies`.

    Equal rows meet in the map-side combine, so a large group of copies never
    travels as such.
    """
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def expand_copies(rows: DataFrame) -> DataFrame:
    """Undo `collapse_copies`: each row as often as `copies` says.

    A row with very many copies is cut into blocks which are spread over tasks
    before they are unrolled.
    """
    columns = [c for c in rows.columns if c != "copies"]
    first = F.lit(0).cast("bigint")
    last_block = F.floor((F.col("copies") - 1) / _COPY_BLOCK)
    blocks = (
        rows.where(F.col("copies") > 0)
        .withColumn("_block", F.explode(F.sequence(first, last_block)))
        .repartition("_block", *columns)
    )
    in_block = F.least(F.col("copies") - F.col("_block") * _COPY_BLOCK, F.lit(_COPY_BLOCK))
    return blocks.withColumn("_copy", F.explode(F.sequence(first + 1, in_block))).select(*columns)


def copies_of(rows: DataFrame) -> Column:
    """How many rows each row stands for."""
    return F.col("copies") if "copies" in rows.columns else F.lit(1).cast("bigint")
