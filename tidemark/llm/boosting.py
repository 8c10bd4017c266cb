"""Gradient-boosted trees for yes or no, over binned features."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic boosting of trees of one depth; every split is a feature and a bin edge, missing nodes repeat their parent's value."""

    def __init__(self, trees: int = 50, depth: int = 5, rate: float = 0.2, bins: int = 32, penalty: float = 1.0, least: float = 4.0):
        self.trees, self.depth, self.rate, self.bins, self.penalty, self.least = trees, depth, rate, bins, penalty, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(width)]
        binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)])
        flat = binned + np.arange(width) * self.bins
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        score = np.full(n, self.start)
        self.feature, self.edge, self.value = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            slope, curve = y - p, p * (1 - p)
            feature = np.zeros((1 << self.depth) - 1, np.int64)
            edge = np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                cell = ((node - first)[:, None] * (width * self.bins) + flat).ravel()
                size = count * width * self.bins
                g = np.bincount(cell, np.repeat(slope, width), size).reshape(count, width, self.bins).cumsum(axis=2)
                h = np.bincount(cell, np.repeat(curve, width), size).reshape(count, width, self.bins).cumsum(axis=2)
                all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
                gain = g**2 / (h + self.penalty) + (all_g - g)**2 / (all_h - h + self.penalty) - all_g**2 / (all_h + self.penalty)
                gain[(h < self.least) | (all_h - h < self.least)] = 0
                best = gain.reshape(count, -1).argmax(axis=1)
                for k, b in enumerate(best.tolist()):
                    f, cut = divmod(b, self.bins)
                    if gain[k, f, cut] > 1e-6 and cut < len(self.edges[f]):
                        feature[first + k], edge[first + k] = f, self.edges[f][cut]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > edge[node])
            leaf = node - ((1 << self.depth) - 1)
            value = self.rate * np.bincount(leaf, slope, 1 << self.depth) / (np.bincount(leaf, curve, 1 << self.depth) + self.penalty)
            score = score + value[leaf]
            self.feature.append(feature)
            self.edge.append(edge)
            self.value.append(value)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of yes."""
        total = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, edge, value in zip(self.feature, self.edge, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, feature[node]] > edge[node])
            total += value[node - ((1 << self.depth) - 1)]
        return total
