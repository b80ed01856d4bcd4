"""Histogram gradient-boosted trees in numpy, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Forest:
    """Complete trees: node i of a tree has children 2i + 1 and 2i + 2, leaves come last."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; every row steps down all trees together."""
        trees, inner = self.feature.shape
        depth = (inner + 1).bit_length() - 1
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for t in range(trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, self.feature[t][node]] > self.threshold[t][node])
            total += self.leaf[t][node - inner]
        return sigmoid(total)


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 2.0, least: float = 1.0,
) -> Forest:
    """Logistic loss; splits by gains of gradient histograms, grown level by level."""
    n, m = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    mean = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(mean / (1 - mean)))
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Forest(feature[:1], threshold[:1], leaf[:1], start)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    edge = np.array([[c[b] if b < len(c) else np.inf for b in range(bins)] for c in cuts])
    total = np.full(n, start)
    for t in range(trees):
        p = sigmoid(total)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            at = node - first
            best = np.full(width, 1e-6)
            for j in range(m):
                cell = at * bins + binned[:, j]
                gl = np.cumsum(np.bincount(cell, g, width * bins).reshape(width, bins), 1)
                hl = np.cumsum(np.bincount(cell, h, width * bins).reshape(width, bins), 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < least) | (ht - hl < least) | ~np.isfinite(edge[j])] = 0
                b = gain.argmax(1)
                for w in np.flatnonzero(gain[np.arange(width), b] > best):
                    best[w] = gain[w, b[w]]
                    feature[t, first + w], threshold[t, first + w] = j, edge[j, b[w]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t][node]] > threshold[t][node])
        at = node - inner
        gs, hs = np.bincount(at, g, leaves), np.bincount(at, h, leaves)
        leaf[t] = -rate * gs / (hs + ridge)
        total += leaf[t][at]
    return Forest(feature, threshold, leaf, start)
