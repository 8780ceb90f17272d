"""Gradient-boosted trees for a yes/no question, on binned features, with numpy alone."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 48


@dataclass
class Trees:
    """Complete trees of equal depth: per inner node a feature and a limit, per leaf a value."""

    features: np.ndarray  # (trees, 2^depth - 1)
    limits: np.ndarray
    leaves: np.ndarray  # (trees, 2^depth)
    bias: float

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        rows, inner = np.arange(len(x)), self.features.shape[1]
        for f, limit, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > limit[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.2, ridge: float = 2.0) -> Trees:
    """Fit by second-order boosting of the logistic loss; exact repeats give exact repeats."""
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    mean = min(max(y.mean(), 1e-4), 1 - 1e-4)
    bias = float(np.log(mean / (1 - mean)))
    total, inner = np.full(n, bias), 2**depth - 1
    features, limits = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, inner + 1))
    offsets = np.arange(width) * (BINS + 1)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            size = width * (BINS + 1)
            key = ((at - first)[:, None] * size + binned + offsets).ravel()
            g = np.bincount(key, np.repeat(grad, width), nodes * size).reshape(nodes, width, BINS + 1)
            h = np.bincount(key, np.repeat(hess, width), nodes * size).reshape(nodes, width, BINS + 1)
            gl, hl = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < 1e-3) | (ht - hl < 1e-3)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), BINS + 1)
                if gain[k, j, b] > 1e-6 and b < len(cuts[j]):
                    features[t, first + k], limits[t, first + k] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), features[t, at]] > limits[t, at])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        leaves[t] = rate * g / (h + ridge)
        total += leaves[t][leaf]
    return Trees(features, limits, leaves, bias)
