"""The operators as queries over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import divergence, licenses, merkle, pieces, pii
from marketloom.llm.class_lm import score_texts
from marketloom.llm.decontaminate import find_contamination
from marketloom.llm.near_dups import near_duplicates
from marketloom.llm.quality_rules import judge
from marketloom.llm.sharding import equal_weights, place
from marketloom.llm.site_quality import score_sites, section
from marketloom.llm.substring_dedup import remove_repeats
from marketloom.llm.token_counts import length_histogram, token_counts
from marketloom.scratch import written

N_SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[pii.n_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.PATTERNS],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for hosts, and a source's languages for its paths."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return score_sites(docs, labels, F.col("source"), section("source", "lang"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
        F.size("near").cast("bigint").alias("n_near"),
    )


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, and what decoding them gives back."""
    encoded = pieces.encode(_table(spark, sf_dir, "documents"))
    return encoded.withColumn("decoded_sha256", F.sha2(pieces.decoded(spark, F.col("ids")), 256))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    placed = place(docs, "doc_id", "text", equal_weights(N_SHARDS), equal_weights(N_SHARDS + 1))
    return placed.withColumn("law", F.lit("key"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = written(token_counts(_table(spark, sf_dir, "documents")), "token_counts")
    return length_histogram(counts)


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.verify(merkle.manifest(_table(spark, sf_dir, "documents")))
    proof = F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii": op2_pii,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scans": op4_license_scans,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_sharding": op9_sharding,
    "op10_token_counts": op10_token_counts,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_divergence": op13_source_divergence,
}
SQL: dict[str, str] = {
    "op4_license_scans": licenses.oracle(),
    "op12_merkle_manifest": merkle.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
