"""Gradient boosted trees for two classes on a bounded table: logistic loss, quantile bins, small trees."""

from __future__ import annotations

import numpy as np


class Boosted:
    """``rounds`` trees of ``depth`` levels; one split (feature, bin) per node, chosen by gain."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 16, weight: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.weight = rounds, depth, rate, bins, weight
        self.trees: list[list[tuple[int, float]]] = []
        self.leaves: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        cuts = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(x.shape[1])]
        cells = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node, splits = np.zeros(len(y), int), []
            for level in range(self.depth):
                for k in range(1 << level):
                    splits.append(self._best(cells, cuts, g, h, np.flatnonzero(node == k)))
                at = splits[-(1 << level):]
                feature, bound = np.array([s[0] for s in at])[node], np.array([s[1] for s in at])[node]
                node = 2 * node + (x[np.arange(len(y)), feature] > bound)
            size = 1 << self.depth
            leaf = np.bincount(node, g, size) / (np.bincount(node, h, size) + self.weight) * self.rate
            margin += leaf[node]
            self.trees.append(splits)
            self.leaves.append(leaf)
        return self

    def _best(self, cells, cuts, g, h, rows) -> tuple[int, float]:
        best = (1e-9, 0, np.inf)
        whole_g, whole_h = g[rows].sum(), h[rows].sum()
        for j, c in enumerate(cuts):
            if not len(c) or len(rows) < 2:
                continue
            left_g = np.cumsum(np.bincount(cells[rows, j], g[rows], len(c) + 1))[:-1]
            left_h = np.cumsum(np.bincount(cells[rows, j], h[rows], len(c) + 1))[:-1]
            gain = left_g**2 / (left_h + self.weight) + (whole_g - left_g)**2 / (whole_h - left_h + self.weight) - (
                whole_g**2 / (whole_h + self.weight))
            if gain.max() > best[0]:
                best = (gain.max(), j, float(c[gain.argmax()]))
        return best[1:]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        margin = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for splits, leaf in zip(self.trees, self.leaves):
            node, first = np.zeros(len(x), int), 0
            for level in range(self.depth):
                at = splits[first:first + (1 << level)]
                feature, bound = np.array([s[0] for s in at])[node], np.array([s[1] for s in at])[node]
                node = 2 * node + (x[rows, feature] > bound)
                first += 1 << level
            margin += leaf[node]
        return 1 / (1 + np.exp(-margin))
