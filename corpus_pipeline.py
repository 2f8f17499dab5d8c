"""A corpus from raw documents to pieces: each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import decontaminate, near_dups, pieces, pii, quality_rules
from marketloom.scratch import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    NULL, empty and short texts go; a repeated row is judged like the first one;
    all columns stay, whatever their names; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    Texts without words are copies of nothing and stay; of rows repeated in full
    one stays; all columns stay; an empty table stays empty.
    """
    return near_dups.keep_one(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates.

    Rows are told apart by id and text, so a clean row stays also when a dirty
    one has its id. NULL and empty texts stay; all columns stay; an empty table
    stays empty, and without a benchmark every row stays.
    """
    row = F.xxhash64("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs.select(row.alias("doc_id"), "text"), benchmark)
    # Stored, so that its size is known before the join and a small one moves no texts.
    dirty = written(found.where("contaminated").select(F.col("doc_id").alias("_dirty")).distinct(), "dirty")
    return docs.join(dirty, row == dirty["_dirty"], "left_anti")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind.

    Every row stays, repeated ones too; NULL and empty texts stay as they are;
    all columns stay; an empty table stays empty.
    """
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document, with the next best segmentations.

    Every row stays, repeated ones too; NULL and empty texts have no pieces; an
    empty table stays empty.
    """
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", clean_of_benchmark),
    ("pii", redacted),
    ("sentencepiece encoding", encoded),
]

# N-gram models, signatures and lattices have no SQL form; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
