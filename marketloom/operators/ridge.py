"""Ridge regression of one series, run inside a task."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Tasks get these functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Samples per block while the normal equations are summed.
_BLOCK = 4096


def _design(runs: np.ndarray) -> np.ndarray:
    flat = runs.reshape(len(runs), -1)
    return np.hstack([flat, np.ones((len(flat), 1))])


def normal_equations(runs: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of products of the inputs with each other and with the targets."""
    width = runs.shape[1] * runs.shape[2] + 1
    gram = np.zeros((width, width))
    moment = np.zeros((width, targets.shape[1]))
    for at in range(0, len(runs), _BLOCK):
        design = _design(runs[at : at + _BLOCK])
        gram += design.T @ design
        moment += design.T @ targets[at : at + _BLOCK]
    return gram, moment


def solve(gram: np.ndarray, moment: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights; the constant term carries no penalty."""
    shrunk = np.append(np.full(len(gram) - 1, penalty), 0.0)
    return np.linalg.solve(gram + np.diag(shrunk), moment)


def predict(runs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.vstack(
        [_design(runs[at : at + _BLOCK]) @ weights for at in range(0, len(runs), _BLOCK)]
    )


def backtest_and_forecast(
    values: np.ndarray, days: int, horizon: int, test_ratio: float, penalty: float, purge: int
) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(training samples, hold-out actuals, hold-out predictions, forecast).

    `values` has one row per day with the price in its first column.
    """
    n_samples = len(values) - days - horizon + 1
    n_train = max(1, min(int(n_samples * (1 - test_ratio)), n_samples - 1))
    seen = values[: days + n_train]
    low, span = seen.min(axis=0), np.ptp(seen, axis=0)
    span[span == 0] = 1.0
    scaled = (values - low) / span

    view = np.lib.stride_tricks.sliding_window_view
    runs = view(scaled, days, axis=0).transpose(0, 2, 1)
    targets = view(scaled[days:, 0], horizon)
    n_fit = max(1, n_train - purge)
    weights = solve(*normal_equations(runs[:n_fit], targets[:n_fit]), penalty)
    tested = predict(runs[n_train:n_samples], weights) * span[0] + low[0]
    ahead = predict(runs[-1:], weights)[0] * span[0] + low[0]
    return n_train, view(values[days:, 0], horizon)[n_train:n_samples], tested, ahead
