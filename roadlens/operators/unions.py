"""Vectorised union of index pairs, for use inside tasks."""

from __future__ import annotations

import numpy as np


def join_roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label[i] is the root of i. Unites the sets of a[k] and b[k] for all k; roots are the smallest index of a set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up
