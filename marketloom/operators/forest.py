"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) fitted and applied by executors.

Each tree sees a small sample chosen by a hash of row contents, so the same
panel gives the same forest however it is partitioned. The forest itself has a
fixed greatest size and is what scoring tasks receive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.skew import content_hash, copies_of
from marketloom.operators.trees import grow_nodes, score_rows
from marketloom.schema import ANOMALY_FEATURES, N_TREES, SEED

FOREST_MODEL = "isolation forest"
SAMPLE_ROWS = 256
# Hash sampling draws this much more than a tree takes, so that chance rarely
# leaves it short.
_SURPLUS = 1.5
NODES = "tree int, node int, feature int, threshold double, path double"


def _uniform(hashed: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))


def tree_sample(
    features: DataFrame,
    n_rows: int,
    n_trees: int = N_TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """Rows for each tree with a `weight`, about 1.5 x `sample_rows` per tree.

    Every row draws one hash number that says how many trees it enters, mostly
    none. Equal rows draw the same number and merge into one weighted row
    before the shuffle, which leaves about n_trees x 384 rows to move at any
    table size. Picks of one row go to trees in turn.
    """
    columns = [c for c in features.columns if c != "copies"]
    rate = min(1.0, _SURPLUS * sample_rows / max(n_rows, 1))
    draw = _uniform(content_hash(columns, "draw", seed))
    picks = F.floor(copies_of(features) * F.lit(rate * n_trees) + draw)
    picked = (
        features.withColumn("_picks", picks)
        .where(F.col("_picks") > 0)
        .groupBy(*columns)
        .agg(F.sum("_picks").alias("_picks"))
    )
    turns = F.least("_picks", F.lit(n_trees)) - 1
    spread = picked.withColumn(
        "_turn", F.explode(F.sequence(F.lit(0).cast("bigint"), turns))
    )
    start = F.pmod(content_hash(columns, "start", seed), F.lit(n_trees))
    rounds = F.floor((F.col("_picks") - 1 - F.col("_turn")) / n_trees) + 1
    assigned = spread.withColumn(
        "tree", F.pmod(start + F.col("_turn"), F.lit(n_trees)).cast("int")
    )
    return assigned.select(
        "tree",
        content_hash([*columns, "tree"], "order", seed).alias("place"),
        rounds.alias("weight"),
        *ANOMALY_FEATURES,
    )


def grow_trees(
    sample: DataFrame, n_trees: int = N_TREES, sample_rows: int = SAMPLE_ROWS, seed: int = SEED
) -> DataFrame:
    """Node table of the forest: one task group per tree."""
    height = max(1, math.ceil(math.log2(sample_rows)))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", *ANOMALY_FEATURES])
        before = rows["weight"].cumsum() - rows["weight"]
        rows = rows[before < sample_rows]
        weight = np.minimum(rows["weight"], sample_rows - before[before < sample_rows])
        tree = int(rows["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        nodes = grow_nodes(rows[ANOMALY_FEATURES].to_numpy(), weight.to_numpy(), height, rng)
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "path"])
        out.insert(0, "tree", tree)
        return out.astype({"threshold": "float64", "path": "float64"})

    tasks = min(n_trees, 4 * sample.sparkSession.sparkContext.defaultParallelism)
    return sample.repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, NODES)


@dataclass
class Forest:
    """A fitted forest: its nodes and the rows each tree was grown from."""

    nodes: pd.DataFrame
    sample_rows: int
    sent: dict[str, Broadcast] = field(default_factory=dict, repr=False, compare=False)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(feature, cut) by tree and inner node, (path) by tree and leaf, sample rows.

        Every tree is filled up to full height: below a shallow leaf rows go left.
        """
        trees, tree = np.unique(self.nodes["tree"], return_inverse=True)
        node, split = self.nodes["node"].to_numpy(), self.nodes["feature"].to_numpy()
        inner = 2 ** max(1, int(np.log2(node.max() + 1))) - 1
        feature = np.zeros((len(trees), inner), dtype="int64")
        cut = np.full((len(trees), inner), np.inf)
        path = np.zeros((len(trees), inner + 1))
        has = split >= 0
        feature[tree[has], node[has]] = split[has]
        cut[tree[has], node[has]] = self.nodes["threshold"].to_numpy()[has]
        tree, leaf = tree[~has], node[~has]
        while (leaf < inner).any():
            leaf = np.where(leaf < inner, 2 * leaf + 1, leaf)
        path[tree, leaf - inner] = self.nodes["path"].to_numpy()[~has]
        return feature, cut, path, self.sample_rows

    def _shared(self, spark: SparkSession) -> Broadcast:
        """The arrays on the executors, sent once per forest and application."""
        app = spark.sparkContext.applicationId
        if app not in self.sent:
            self.sent[app] = spark.sparkContext.broadcast(self.arrays())
        return self.sent[app]

    def score(self, features: DataFrame) -> DataFrame:
        """Adds column `score`, in [-1, 0)."""
        shared = self._shared(features.sparkSession)

        @F.pandas_udf("double")
        def score_batch(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            arrays = shared.value
            for columns in batches:
                x = np.column_stack(columns).astype("float64")
                yield pd.Series(score_rows(x, *arrays))

        return features.withColumn("score", score_batch(*ANOMALY_FEATURES))

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The forest as rows, with the sample size, to be stored."""
        nodes = spark.createDataFrame(pa.Table.from_pandas(self.nodes, preserve_index=False))
        return nodes.withColumn("sample_rows", F.lit(self.sample_rows))

    @classmethod
    def from_node_table(cls, table: DataFrame) -> Forest:
        nodes = table.toArrow().to_pandas()
        return cls(nodes.drop(columns="sample_rows"), int(nodes["sample_rows"].iloc[0]))


def fit_forest(
    features: DataFrame,
    n_trees: int = N_TREES,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> Forest | None:
    """Forest of a feature table; None when it is empty.

    At most n_trees x (4 x sample_rows) nodes come to the driver, whatever the
    table holds.
    """
    n_rows = features.agg(F.sum(copies_of(features)).alias("n")).first()["n"]
    if not n_rows:
        return None
    size = min(sample_rows, n_rows)
    sample = tree_sample(features, n_rows, n_trees, sample_rows, seed)
    return Forest(grow_trees(sample, n_trees, size, seed).toArrow().to_pandas(), size)
