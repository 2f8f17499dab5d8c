"""Exact histogram of encoded lengths, and what follows from its suffix sums.

Documents are encoded whole. The histogram has one row per distinct length, so
it stays small while the corpus grows; totals, quantiles and truncated totals at
any context limit need no second look at the documents.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.words import slices, worker_cache

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the word pattern that belongs to this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Lengths whose sums are taken side by side.
LENGTH_BLOCK = 1024
# Longer runs of white space are encoded apart: the pattern's look-ahead would take one step of stack for each.
_LONG_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{10000,}")


def _encoding(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file, made once per Python process."""
    cache = worker_cache("token_counts")
    name = f"tiktoken-{hashlib.sha256(vocabulary + pattern.encode()).hexdigest()}"
    if name not in cache:
        pairs = (line.split() for line in vocabulary.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        cache[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return cache[name]


def encode_length(encoding: tiktoken.Encoding, text: str) -> int:
    """Tokens of a text. A long run of white space is one piece, but for its last sign before a word."""
    total, at = 0, 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() - (run.end() < len(text))
        total += len(encoding.encode_ordinary(text[at : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def _count(vocabulary, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary.value, pattern)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            lengths = [encode_length(encoding, text) for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return count


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """doc_id and n_tokens of every row; the text is ordinary text throughout, without special tokens."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:  # a public file on the driver, sent to the tasks
        shared = spark.sparkContext.broadcast(file.read())
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_count(shared, pattern), "doc_id bigint, n_tokens bigint")


def length_histogram(counts: DataFrame) -> DataFrame:
    """Every distinct length with its suffix sums.

    Returns n_tokens, n_docs, docs_below, docs_longer, tokens_at_most (of the
    documents up to this length), truncated_tokens (of all documents, each cut at
    this length), total_tokens, and quantile (share of documents up to this
    length). Sums run inside blocks of lengths and over the blocks, so that no
    task sees more than a block's rows or one row per block.

    Defined cases: a NULL text counts as empty and has length 0; repeated rows
    count each; an empty table gives an empty result.
    """
    rows = counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    rows = rows.withColumns(
        {"tokens": F.col("n_tokens") * F.col("n_docs"), "block": F.floor(F.col("n_tokens") / LENGTH_BLOCK)}
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    ordered = Window.partitionBy(F.lit(0)).orderBy("block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    offsets = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("docs").over(whole).alias("all_docs"),
        F.sum("tokens").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(offsets, "block").withColumns(
        {
            "docs_at_most": F.col("docs_before") + F.sum("n_docs").over(inside),
            "tokens_at_most": F.col("tokens_before") + F.sum("tokens").over(inside),
        }
    )
    longer = F.col("all_docs") - F.col("docs_at_most")
    return summed.select(
        "n_tokens",
        "n_docs",
        (F.col("docs_at_most") - F.col("n_docs")).alias("docs_below"),
        longer.alias("docs_longer"),
        "tokens_at_most",
        (F.col("tokens_at_most") + F.col("n_tokens") * longer).alias("truncated_tokens"),
        F.col("all_tokens").alias("total_tokens"),
        (F.col("docs_at_most") / F.col("all_docs")).alias("quantile"),
    )


def at_limits(spark: SparkSession, histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Documents cut and tokens kept at each asked context limit: limit, docs_cut, kept_tokens."""
    kept = [F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")) for limit in limits]
    cut = [F.sum(F.when(F.col("n_tokens") > limit, F.col("n_docs")).otherwise(0)) for limit in limits]
    rows = [
        F.struct(F.lit(limit).cast("bigint").alias("limit"), F.coalesce(c, F.lit(0)).alias("docs_cut"), F.coalesce(k, F.lit(0)).alias("kept_tokens"))
        for limit, c, k in zip(limits, cut, kept, strict=True)
    ]
    return histogram.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The smallest length that at least this share of the documents does not exceed, as n_tokens."""
    return histogram.where(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
