"""A random forest in numpy: trees of axis-parallel splits on bootstrap samples, grown by Gini impurity."""

from __future__ import annotations

import numpy as np


class Forest:
    """Fits on the driver; predicts by walking all rows down every tree at once."""

    def __init__(self, trees: int = 40, depth: int = 8, least: int = 4, cuts: int = 12, seed: int = 11):
        self.trees, self.depth, self.least, self.cuts = trees, depth, least, cuts
        self.rng = np.random.default_rng(seed)
        self.forest: list[tuple[np.ndarray, ...]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        """x: (rows, features); y: 0 or 1."""
        for _ in range(self.trees):
            rows = self.rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []  # feature (-1: leaf), cut, left, right, share of label 1
            self._grow(x[rows], y[rows], 0, nodes)
            t = np.array(nodes)
            self.forest.append((t[:, 0].astype(np.int64), t[:, 1], t[:, 2].astype(np.int64), t[:, 3].astype(np.int64), t[:, 4]))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, nodes: list[list[float]]) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, at, at, (y.sum() + 0.5) / (len(y) + 1)])
        if depth == self.depth or len(y) < 2 * self.least or y.min() == y.max():
            return at
        best = (0.0, -1, 0.0)
        base = self._impurity(y.sum(), len(y))
        for f in self.rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5) + 1), replace=False):
            for cut in np.unique(self.rng.choice(x[:, f], self.cuts)):
                left = x[:, f] <= cut
                n = left.sum()
                if min(n, len(y) - n) < self.least:
                    continue
                p = y[left].sum()
                gain = base - self._impurity(p, n) - self._impurity(y.sum() - p, len(y) - n)
                if gain > best[0]:
                    best = (gain, f, cut)
        if best[1] < 0:
            return at
        left = x[:, best[1]] <= best[2]
        nodes[at][0:2] = [best[1], best[2]]
        nodes[at][2] = self._grow(x[left], y[left], depth + 1, nodes)
        nodes[at][3] = self._grow(x[~left], y[~left], depth + 1, nodes)
        return at

    @staticmethod
    def _impurity(ones: float, n: float) -> float:
        return 2 * ones * (n - ones) / n

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean share of label 1 over the trees, for each row."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, share in self.forest:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[at]
                go_left = x[rows, np.maximum(f, 0)] <= cut[at]
                at = np.where(f < 0, at, np.where(go_left, left[at], right[at]))
            total += share[at]
        return total / max(1, len(self.forest))
