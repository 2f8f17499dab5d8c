"""Connected components of a large graph by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.scratch import written


def connected(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node it reaches) of every node of the edges (a, b).

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so a path of length n needs about log n rounds. Labels
    are written after every round; nothing but one count reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct()
    both = written(both, "edges")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("lower")
        )
        up = labels.select(F.col("node").alias("lower"), F.col("label").alias("top"))
        jumped = moved.join(up, "lower").select("node", F.col("label").alias("old"), F.least("lower", "top").alias("label"))
        new = written(jumped, "labels")
        labels = new.select("node", "label")
        if new.where("label < old").isEmpty():
            return labels
