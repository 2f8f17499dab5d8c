import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import anomaly
from marketloom.operators.forest import Forest, fit_forest, grow_trees, tree_sample
from marketloom.operators.trees import mean_path
from marketloom.plans.batch import detect_anomalies
from marketloom.schema import ANOMALY_FEATURES, PANEL_SCHEMA


@pytest.fixture(scope="module")
def panel(make_panel):
    rng = random.Random(1)
    rows = [
        {
            "day": d,
            "region": f"R{r}",
            "price": float(rng.randint(90, 110)),
            "rain_mm": float(rng.randint(0, 9)),
            "temp_avg_c": float(rng.randint(20, 30)),
            "is_weekend": int(d % 7 >= 5),
        }
        for d in range(80)
        for r in range(10)
    ]
    rows[333]["price"] = 2000.0
    return make_panel(rows).persist()


@pytest.fixture(scope="module")
def features(panel):
    return anomaly.anomaly_features(panel, compact=True).persist()


@pytest.fixture(scope="module")
def found(panel):
    return detect_anomalies(panel, n_trees=50)


def test_sample_is_the_same_for_any_partitioning(features):
    one = tree_sample(features.coalesce(1), 800, 20)
    many = tree_sample(features.orderBy(F.rand(3)).repartition(7), 800, 20)
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, many.collect()))


def test_sample_sizes(features):
    sizes = [r[1] for r in tree_sample(features, 800, 20).groupBy("tree").sum("weight").collect()]
    assert len(sizes) == 20 and min(sizes) >= 256 and max(sizes) < 800


def test_small_table_is_sampled_whole(features):
    few = features.orderBy("obs_date", "region").limit(100)
    sizes = tree_sample(few, 100, 10).groupBy("tree").agg(F.sum("weight"), F.count("*")).collect()
    assert {tuple(r)[1:] for r in sizes} == {(100, 100)}


def test_copies_are_sampled_as_weight(features):
    """A row with a third of all copies takes a third of each tree, as one row."""
    heavy = features.withColumn(
        "copies",
        F.when((F.col("region") == "R3") & (F.col("obs_date") == "2024-01-09"), 4_000_000).otherwise(
            10_000
        ).cast("bigint"),
    )
    total = heavy.agg(F.sum("copies")).first()[0]
    sample = tree_sample(heavy, total, 10).groupBy("tree").agg(
        F.sum("weight").alias("n"), F.max("weight").alias("heavy"), F.count("*").alias("rows")
    )
    for row in sample.collect():
        assert row.heavy / row.n == pytest.approx(1 / 3, abs=0.08)
        assert row.rows < 400


def test_equal_rows_merge_before_the_shuffle(features):
    twice = features.unionByName(features)
    a = tree_sample(twice, 1600, 20).agg(F.sum("weight")).first()[0]
    assert a == pytest.approx(20 * 384, rel=0.15)
    assert tree_sample(twice, 1600, 20).count() <= 20 * 800


def walk(nodes, x):
    """Path of one row through one tree, by recursion."""
    node = 0
    while nodes[node]["feature"] >= 0:
        go = nodes[node]
        node = 2 * node + (2 if x[go["feature"]] > go["threshold"] else 1)
    return nodes[node]["path"]


def test_scores_follow_the_nodes(features, found):
    trees = {}
    for row in found.forest.nodes.to_dict("records"):
        trees.setdefault(row["tree"], {})[row["node"]] = row
    assert len(trees) == 50
    scale = mean_path(256)
    for row in found.forest.score(features).limit(40).collect():
        x = [row[c] for c in ANOMALY_FEATURES]
        depth = np.mean([walk(nodes, x) for nodes in trees.values()])
        assert row.score == pytest.approx(-(2 ** (-depth / scale)))


def test_nodes_hold_the_whole_sample(features):
    """Leaf sizes, taken back from their paths, add up to 256 rows."""
    nodes = grow_trees(tree_sample(features, 800, 8), 8).toPandas()
    assert nodes["node"].max() < 2**9 - 1
    by_path = {round(mean_path(n), 9): n for n in range(1, 257)}
    by_path[0.0] = 1
    for _, tree in nodes.groupby("tree"):
        leaves = tree[tree["feature"] < 0]
        depth = np.floor(np.log2(leaves["node"] + 1))
        sizes = [by_path[round(v, 9)] for v in leaves["path"] - depth]
        assert sum(sizes) == 256


def test_flags_and_report(panel, found):
    flagged = found.flagged.persist()
    assert flagged.where("score < -1 or score >= 0 or score is null").count() == 0
    summary = anomaly.anomaly_summary(flagged, "m").first()
    assert summary.total_rows == panel.count()
    assert abs(summary.pct_anomalies - 3) <= 0.5
    top = anomaly.top_anomalies(flagged).collect()
    assert [r.score for r in top] == sorted(r.score for r in top)
    assert any(r.price == 2000 for r in top)
    daily = anomaly.anomaly_daily(flagged).collect()
    assert len(daily) == 80
    assert sum(r.n_anomalies for r in daily) == summary.total_anomalies


def test_forest_is_repeatable_and_can_be_stored(spark, panel, found):
    again = detect_anomalies(panel.repartition(3), n_trees=50)
    assert again.threshold == found.threshold
    stored = Forest.from_node_table(found.forest.node_table(spark).repartition(4))
    for a, b in zip(stored.arrays(), found.forest.arrays()):
        assert np.array_equal(a, b)


def test_layout_of_copies_changes_nothing(panel, found):
    """Many copies of a few rows: the forest is the same however they lie."""
    copies = panel.limit(3).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("_n")
    mixed = panel.unionByName(copies)
    forests = [
        fit_forest(anomaly.anomaly_features(rows, compact=True), n_trees=50)
        for rows in (mixed, mixed.orderBy("price").repartition(5, "region"))
    ]
    order = ["tree", "node"]
    one, other = (f.nodes.sort_values(order).reset_index(drop=True) for f in forests)
    assert one.equals(other)


def test_constant_rows(make_panel):
    run = detect_anomalies(make_panel([{"day": 0}] * 30), n_trees=5)
    assert run.flagged.where("is_anom = 1").count() == 0
    assert math.isclose(run.threshold, -0.5, abs_tol=1e-9)


def test_empty_panel(spark):
    run = detect_anomalies(spark.createDataFrame([], PANEL_SCHEMA))
    assert run.forest is None and run.flagged.count() == 0
    row = anomaly.anomaly_summary(run.flagged, "m").first()
    assert (row.total_anomalies, row.total_rows, row.pct_anomalies) == (0, 0, 0.0)


def test_single_region_has_no_deviation(make_series):
    rows = anomaly.anomaly_features(make_series([5, 0, 7])).orderBy("obs_date").collect()
    assert [r.deviation_pct for r in rows] == [0, 0, 0]
    assert [r.delta_pct for r in rows] == [0, -100, 0]


def test_top_list_repeats_copies(found):
    flagged = found.flagged.withColumn("copies", F.lit(30).cast("bigint"))
    top = anomaly.top_anomalies(flagged, 50).collect()
    assert len(top) == 50 and top[0] == top[29] and top[29] != top[30]
