"""Isolation trees grown and applied inside a task."""

from __future__ import annotations

import math
import sys

import numpy as np
from pyspark import cloudpickle

# Tasks get these functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def grow_nodes(x: np.ndarray, weight: np.ndarray, height: int, rng) -> list[tuple]:
    """(node, feature, threshold, path) of one tree; children of i: 2i+1, 2i+2."""
    nodes = []
    todo = [(0, 0, np.arange(len(x)))]
    while todo:
        node, depth, rows = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth == height or not len(varying):
            nodes.append((node, -1, None, depth + mean_path(weight[rows].sum())))
            continue
        feature = int(rng.choice(varying))
        cut = rng.uniform(low[feature], high[feature])
        if cut >= high[feature]:
            cut = low[feature]
        nodes.append((node, feature, float(cut), None))
        right = x[rows, feature] > cut
        todo.append((2 * node + 1, depth + 1, rows[~right]))
        todo.append((2 * node + 2, depth + 1, rows[right]))
    return nodes


def score_rows(
    x: np.ndarray,
    feature: np.ndarray,
    threshold: np.ndarray,
    path: np.ndarray,
    sample_rows: int,
) -> np.ndarray:
    """-2^(-mean path / mean path of the sample): lower is stranger.

    Trees are full: inner nodes in heap order, then the leaves.
    """
    inner = path.shape[1] - 1
    height = int(np.log2(inner + 1))
    flat, offset = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    total = np.zeros(len(x))
    for of_tree, cuts, depths in zip(feature, threshold, path):
        node = 1 + (x[:, of_tree[0]] > cuts[0])
        for _ in range(height - 1):
            right = flat.take(offset + of_tree.take(node)) > cuts.take(node)
            node *= 2
            node += 1
            node += right
        total += depths.take(node - inner)
    scale = mean_path(sample_rows) or 1.0
    return -np.exp2(-total / (len(path) * scale))
