"""Gradient-boosted trees for a yes or no, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Forest:
    """Complete binary trees of one depth: split feature and threshold by inner node, value by leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def probability(self, rows: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.value.shape[1]))
        margin = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            margin += value[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-margin))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 5, rate: float = 0.3, smooth: float = 5.0) -> Forest:
    """Trees on the gradient of the log loss; every split is the best of at most ``BINS`` cuts a feature."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.column_stack([np.searchsorted(cut, column) for cut, column in zip(cuts, rows.T)])
    n, width = binned.shape
    edges = np.array([np.pad(cut, (0, BINS - len(cut)), constant_values=np.inf) for cut in cuts])
    slot = binned + np.arange(width) * BINS
    prior = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(prior / (1 - prior)))
    margin = np.full(n, start)
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = labels - p, p * (1 - p)
        feature, threshold = np.zeros(2**depth - 1, dtype=np.int64), np.full(2**depth - 1, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            where = ((node - first)[:, None] * (width * BINS) + slot).ravel()
            g, h = (
                np.bincount(where, np.repeat(w, width), count * width * BINS).reshape(count, width, BINS).cumsum(axis=2)
                for w in (gradient, curvature)
            )
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + smooth) + (all_g - g) ** 2 / (all_h - h + smooth) - all_g**2 / (all_h + smooth)
            gain = gain.reshape(count, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > 1e-6
            feature[first : first + count] = np.where(split, best // BINS, 0)
            threshold[first : first + count] = np.where(split, edges[best // BINS, best % BINS], np.inf)
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > threshold[node])
        leaf = node - (2**depth - 1)
        value = rate * np.bincount(leaf, gradient, 2**depth) / (np.bincount(leaf, curvature, 2**depth) + smooth)
        margin += value[leaf]
        out.append((feature, threshold, value))
    return Forest(*(np.array(part) for part in zip(*out)), start)
