"""Weighted rendezvous hashing of records over shards.

Every (key, shard) pair has a pseudo-random draw; a key goes to the shard with
the greatest weighted draw. The draws of the other shards do not change when a
shard is added, removed or weighted anew, so only rows that gain or lose by that
shard move. Everything here is Spark SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketloom.scratch import written

# Parts of one shard that are numbered side by side.
SLOT_PARTS = 256
# Copies of one row that one row stands for while copies are spread out.
COPY_BLOCK = 10_000


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key; weights by shard number, 0 or less keeps a shard empty.

    The draw is -weight / ln(u) with u in (0, 1) from a hash of key and shard.
    Equal draws go to the greater number. A NULL key has draws of its own.
    """
    open_shards = {shard: weight for shard, weight in sorted(weights.items()) if weight > 0}
    if not open_shards:
        raise ValueError("no shard has a positive weight")
    shards = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in open_shards.items()])

    def draw(x: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, x["shard"]), 11).cast("double")
        u = (bits + 0.5) / float(1 << 53)
        return F.struct((-x["weight"] / F.log(u)).alias("draw"), x["shard"].alias("shard"))

    return F.array_max(F.transform(shards, draw))["shard"]


def equal_weights(n_shards: int) -> dict[int, float]:
    return dict.fromkeys(range(n_shards), 1.0)


def place(rows: DataFrame, key: str, text: str, weights: Mapping[int, float], grown: Mapping[int, float]) -> DataFrame:
    """Shard and place of every row, without its text.

    Returns key, size (UTF-8 bytes and 8 more for the key), text_crc32, shard,
    slot (from 0 without gaps in each shard) and grown_shard, the shard under the
    weights `grown`. Rows of one key share a shard by the law of the hash; the
    slots inside it are dealt in parts, and copies of a row are counted before
    they are dealt, so no key has to fit into one task.

    Defined cases: a NULL text has no bytes, as an empty one; a NULL key is a key
    like any other; rows repeated in full get a slot each; an empty table gives
    an empty result; other columns are not read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    slim = rows.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 8).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    grouped = slim.groupBy("key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    placed = written(
        grouped.withColumns(
            {
                "shard": rendezvous(F.col("key"), weights),
                "grown_shard": rendezvous(F.col("key"), grown),
                "part": F.pmod(F.xxhash64("key", "size", "text_crc32"), F.lit(SLOT_PARTS)),
            }
        ),
        "placed",
    )
    so_far = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("shard", "part").agg(F.sum("n").alias("n"))  # shards times SLOT_PARTS rows
    offsets = parts.select("shard", "part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("offset"))
    inside = (
        Window.partitionBy("shard", "part").orderBy("key", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    based = placed.join(offsets, ["shard", "part"]).withColumn("base", before)
    return expand(based, "n", "base", "slot", ("key", "size", "text_crc32")).select(
        F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard"
    )


def expand(rows: DataFrame, n: str, base: str, name: str, keys: Sequence[str]) -> DataFrame:
    """One row per copy, with base, base + 1, ... as column `name`; blocks of copies are spread over tasks."""
    blocks = F.sequence(F.lit(0), F.ceil(F.col(n) / COPY_BLOCK).cast("bigint") - 1)
    spread = rows.withColumn("_block", F.explode(blocks)).repartition(*keys, "_block")
    first = F.col("_block") * COPY_BLOCK
    last = F.least(F.col(n), first + COPY_BLOCK) - 1
    return spread.withColumn("_copy", F.explode(F.sequence(first, last))).withColumn(name, F.col(base) + F.col("_copy"))


def write_shards(rows: DataFrame, key: str, weights: Mapping[int, float], path: str, parts: int = 8) -> None:
    """Write whole rows as Parquet, one folder per shard; a shard's rows come from up to `parts` tasks.

    Every column is kept, so a column named `shard` in the rows is refused.
    """
    if "shard" in rows.columns:
        raise ValueError("rows already have a column named shard")
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`").cast(T.StringType()) for c in rows.columns]), F.lit(parts))
    (
        rows.withColumn("shard", rendezvous(F.col(key), weights))
        .withColumn("_part", part)
        .repartition("shard", "_part")
        .drop("_part")
        .write.partitionBy("shard")
        .parquet(path)
    )
