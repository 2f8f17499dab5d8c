"""Quality scores that combine a document classifier with its site, by hierarchical empirical Bayes.

A logistic regression on text statistics gives each document a probability of
being good. Paths and hosts get posterior means of that evidence: a path is
shrunk toward its host and a host toward the global mean, the more the fewer
documents it has. How strongly follows from the variances within and between
sites, which grouped sums over the whole corpus give. A document's final score
moves its own log odds by how far its path stands from the global mean.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.quality_rules import per_text, rule_counts
from marketloom.llm.words import SPACED, column_bytes, find_words, slices
from marketloom.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Labelled documents that the classifier is fitted on, at most.
TRAIN_ROWS = 20_000
RIDGE = 1e-3
# Log odds of one document's evidence, and of a site's posterior, stay within these bounds.
MOST_LOG_ODDS = 8.0
MOST_SITE_LOG_ODDS = 3.0
# A document is kept from this score on.
THRESHOLD = 0.5

FEATURES = (
    "log_words", "word_length", "signs", "repeated_lines", "repeated_words",
    "capitals", "digits", "punctuation", "distinct_words", "line_length",
)
_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_POINT = np.zeros(256, bool)
_POINT[list(b".,;:!?'\"()-")] = True


def text_features(column: pa.Array) -> np.ndarray:
    """FEATURES of every text; all are 0 where there are no words."""
    counts = rule_counts(column)
    data, bounds = column_bytes(column)
    words = find_words(column, SPACED, lower=True)
    text = words.text_of_word()
    order = np.lexsort((words.codes, text))
    new = np.ones(len(order), bool)
    new[1:] = (words.codes[order][1:] != words.codes[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][new], minlength=len(column))
    n_words = counts["n_words"]
    n, chars = np.maximum(n_words, 1), np.maximum(counts["word_chars"], 1)
    lines = 1 + per_text(data == 0x0A, bounds)
    columns = [
        np.log1p(n_words),
        counts["word_chars"] / n / 10,
        counts["n_symbols"] / chars,
        counts["n_dup_lines"] / lines,
        counts["n_repeat_words"] / n,
        per_text(_CAPITAL[data], bounds) / chars,
        per_text(_DIGIT[data], bounds) / chars,
        per_text(_POINT[data], bounds) / chars,
        distinct / n,
        np.log1p(counts["word_chars"] / lines) / 5,
    ]
    return np.where(n_words[:, None] > 0, np.stack(columns, axis=1), 0.0)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values = text_features(batch.column("text"))
        arrays = [pa.array(values[:, k]) for k in range(values.shape[1])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("host"), batch.column("path"), *arrays],
            ["doc_id", "host", "path", *FEATURES],
        )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression, the intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge * max(len(x), 1))
    penalty[-1] = 1e-9
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(features: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> np.ndarray:
    """Classifier weights from about `rows` labelled documents, chosen by a hash of id.

    Labels other than 0 and 1 are left out; of contradictory labels, and of rows
    that share an id, the greatest value counts. Without both kinds of label the
    classifier says the share of good ones everywhere (one half without labels).
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    known = known.where("y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, rows / max(known.count(), 1))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = features.join(some, "doc_id").groupBy("doc_id").agg(*[F.max(c).alias(c) for c in [*FEATURES, "y"]])
    data = np.array([tuple(r) for r in sample.select(*FEATURES, "y").collect()], float).reshape(-1, len(FEATURES) + 1)
    data = data[np.lexsort(data.T)]
    if len(set(data[:, -1])) < 2:
        share = np.clip(data[:, -1].mean() if len(data) else 0.5, 0.05, 0.95)
        return np.append(np.zeros(len(FEATURES)), np.log(share / (1 - share)))
    # Both kinds weigh the same, as labels need not follow the corpus.
    return fit_logistic(data[:, :-1], data[:, -1])


def _log_odds(p: Column, most: float) -> Column:
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.greatest(F.lit(-most), F.least(F.lit(most), F.log(p / (1 - p))))


def _posterior(n: Column, mean: Column, prior: Column, within: float, between: float) -> Column:
    """Mean of a site shrunk toward its prior."""
    trust = n / (n + (within / between)) if between > 0 else F.lit(0.0)
    return trust * mean + (1 - trust) * prior


def _variance_between(n_all: float, n_sites: int, squares: float, spread: float, within: float) -> float:
    """Between-site variance by the method of moments; `spread` is the sum of n * (mean - overall mean) ** 2."""
    room = n_all - squares / max(n_all, 1.0)
    return max(0.0, (spread - (n_sites - 1) * within) / room) if room > 0 else 0.0


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior) of every path, and the global mean.

    `evidence` has host, path and p. Only sums reach the driver.
    """
    paths = evidence.groupBy("host", "path").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")
    )
    paths = written(paths, "path_sums")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), F.sum("s").alias("s_host"))
    total = paths.agg(F.sum("n"), F.sum("s"), F.sum("q"), F.sum(F.col("s") * F.col("s") / F.col("n")), F.count(F.lit(1))).first()
    n_all, s_all, q_all, path_part, n_paths = (float(v or 0) for v in total)
    mean = s_all / n_all if n_all else 0.5
    within = max(1e-9, (q_all - path_part) / max(n_all - n_paths, 1.0))
    host_mean = F.col("s_host") / F.col("n_host")
    row = hosts.agg(
        F.count(F.lit(1)), F.sum(F.col("n_host") ** 2), F.sum(F.col("n_host") * (host_mean - F.lit(mean)) ** 2)
    ).first()
    n_hosts, squares, spread = (float(v or 0) for v in row)
    between_hosts = _variance_between(n_all, int(n_hosts), squares, spread, within)
    joined = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    path_mean = F.col("s") / F.col("n")
    row = joined.agg(
        F.sum(F.col("n") ** 2 / F.col("n_host")), F.sum(F.col("n") * (path_mean - host_mean) ** 2)
    ).first()
    squares, spread = (float(v or 0) for v in row)
    room = n_all - squares
    between_paths = max(0.0, (spread - (n_paths - n_hosts) * within) / room) if room > 0 else 0.0
    with_host = joined.withColumn(
        "host_posterior", _posterior(F.col("n_host"), host_mean, F.lit(mean), within, between_hosts)
    )
    return with_host.select(
        "host",
        "path",
        "host_posterior",
        _posterior(F.col("n"), path_mean, F.col("host_posterior"), within, between_paths).alias("path_posterior"),
    ), mean


def score_sites(docs: DataFrame, labels: DataFrame, host: Column, path: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Score of every row of `docs` (doc_id, text) whose site is given by `host` and `path`.

    Returns doc_id, host, path, evidence (classifier's probability), host_posterior,
    path_posterior, score and kept (score at least `threshold`).

    Defined cases: NULL and empty texts have features of 0; a NULL host or path is
    a site of its own; repeated rows count each; without usable labels the
    evidence is one half everywhere; an empty table gives an empty result.
    """
    slim = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
    )
    schema = "doc_id bigint, host string, path string, " + ", ".join(f"{name} double" for name in FEATURES)
    features = written(slim.mapInArrow(_features, schema), "features")
    weights = train(features, labels)
    logit = F.lit(float(weights[-1]))
    for name, weight in zip(FEATURES, weights, strict=False):
        logit = logit + F.col(name) * F.lit(float(weight))
    evidence = features.withColumn("p", 1 / (1 + F.exp(-logit))).select("doc_id", "host", "path", "p")
    sites, mean = site_posteriors(evidence)
    same = evidence["host"].eqNullSafe(sites["host"]) & evidence["path"].eqNullSafe(sites["path"])
    shift = _log_odds(F.col("path_posterior"), MOST_SITE_LOG_ODDS) - _log_odds(F.lit(mean), MOST_SITE_LOG_ODDS)
    score = 1 / (1 + F.exp(-(_log_odds(F.col("p"), MOST_LOG_ODDS) + shift)))
    return (
        evidence.join(sites, same, "left")
        .drop(sites["host"])
        .drop(sites["path"])
        .select(
            "doc_id", "host", "path", F.col("p").alias("evidence"), "host_posterior", "path_posterior", score.alias("score")
        )
        .withColumn("kept", F.col("score") >= threshold)
    )


def section(*parts: str | Sequence[str]) -> Column:
    """A path made of columns, NULL parts as empty."""
    return F.concat_ws("/", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
