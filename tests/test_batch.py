import pytest

from marketloom.plans import batch
from marketloom.sources.results import ResultStore


@pytest.fixture(scope="module")
def panel(make_panel):
    return make_panel(
        [
            {"day": d, "region": r, "commodity": c, "price": 50.0 + (d * 7 + len(c) * k) % 11}
            for d in range(65)
            for k, r in enumerate("ABC")
            for c in ("rice", "oil")
        ]
        + [{"day": d, "commodity": "new", "price": 9.0} for d in range(3)]
    )


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("results"))


@pytest.fixture(scope="module")
def first(panel, root):
    return batch.run_batch(panel, root)


def test_all_tables(first, panel):
    assert set(first) == {
        "dataset_info", "forecast", "backtest", "history", "forecast_metrics", "series_meta",
        "forecast_records", "scored", "threshold", "forest", "anomaly_summary", "top_anomalies",
        "anomaly_daily",
    }
    assert first["dataset_info"].first().total_rows == panel.count()
    assert first["forecast"].count() == 21
    assert {r.commodity: r.n_days for r in first["series_meta"].collect()} == {
        "rice": 65, "oil": 65, "new": 3,
    }
    assert first["anomaly_summary"].first().total_rows == panel.count()
    assert batch.as_json(first["threshold"]).count() == 1


def runs(spark, root):
    return spark.read.parquet(f"{root}/version=2/finished").count()


def test_second_run_reads_the_store(spark, first, panel, root):
    empty = panel.where("price < 0")
    again = batch.run_batch(empty, root)
    assert set(again) == set(first) and runs(spark, root) == 1
    for name in first:
        assert sorted(map(str, again[name].collect())) == sorted(map(str, first[name].collect()))


def test_other_version_is_made_anew(panel, first, root):
    small = panel.where("commodity = 'new'")
    other = batch.run_batch(small, root, version=3)
    assert other["forecast"].count() == 7
    assert batch.run_batch(small, root)["forecast"].count() == 21


def test_unfinished_run_is_not_read(spark, panel, first, root, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    store.write("broken", "forecast", first["forecast"])
    assert store.latest() is None


def test_force_makes_a_new_run(spark, panel, first, root):
    small = panel.where("commodity = 'new'")
    assert batch.run_batch(small, root, force=True)["forecast"].count() == 7
    assert runs(spark, root) == 2
    assert batch.run_batch(panel, root)["forecast"].count() == 7
    assert first["forecast"].count() == 21
