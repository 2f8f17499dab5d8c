import numpy as np
import pytest

from marketloom.operators import quantile

RNG = np.random.default_rng(3)
CASES = {
    "spread": RNG.normal(size=3000).tolist(),
    "ties": RNG.integers(0, 5, 999).astype(float).tolist(),
    "one value": [2.5] * 40,
    "one row": [7.0],
    "neighbours": [1.0, np.nextafter(1.0, 2.0), np.nextafter(1.0, 2.0)],
    "far apart": [-1e300, 0.0, 1e-300, 1e300, 5.0],
    "crowded": (1 + RNG.random(2000) * 1e-12).tolist() + [1e9],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("q", [0.0, 0.03, 0.5, 1.0])
def test_same_as_numpy(spark, name, q, monkeypatch):
    monkeypatch.setattr(quantile, "_BINS", 16)
    df = spark.createDataFrame([(float(v),) for v in CASES[name]], "v double")
    got = quantile.exact_quantile(df, "v", q)
    expected = np.percentile(CASES[name], q * 100)
    assert got == pytest.approx(expected, rel=1e-12, abs=1e-300)


def test_weights_count_as_copies(spark):
    values = [(1.0, 3), (2.0, 1), (4.0, 96), (None, 5), (float("nan"), 5)]
    df = spark.createDataFrame(values, "v double, n bigint")
    plain = [1.0] * 3 + [2.0] + [4.0] * 96
    for q in (0.0, 0.02, 0.03, 0.031, 0.9):
        assert quantile.exact_quantile(df, "v", q, "n") == pytest.approx(np.percentile(plain, q * 100))


def test_nothing_has_no_quantile(spark):
    assert quantile.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5) is None
