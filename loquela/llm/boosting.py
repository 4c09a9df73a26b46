"""Gradient-boosted shallow trees: fitted on the driver from a bounded sample, applied as a JVM expression."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A node is (feature, threshold, left, right); a leaf is a float.
Node = tuple | float


@dataclass
class BoostedTrees:
    """Logistic gradient boosting with exact splits on few distinct values per feature."""

    rounds: int = 24
    depth: int = 3
    rate: float = 0.4
    bins: int = 32
    bias: float = 0.0
    trees: list[Node] = field(default_factory=list)

    def _grow(self, x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int) -> Node:
        value = float(-grad[rows].sum() / (hess[rows].sum() + 1e-3) * self.rate)
        if depth == 0 or len(rows) < 2:
            return value
        best = (1e-6, -1, 0.0)
        total_g, total_h = grad[rows].sum(), hess[rows].sum()
        base = total_g**2 / (total_h + 1e-3)
        for f in range(x.shape[1]):
            levels = np.unique(x[rows, f])
            if len(levels) > self.bins:
                levels = np.unique(np.quantile(levels, np.linspace(0, 1, self.bins)))
            for cut in (levels[1:] + levels[:-1]) / 2:
                left = rows[x[rows, f] <= cut]
                g, h = grad[left].sum(), hess[left].sum()
                gain = g**2 / (h + 1e-3) + (total_g - g) ** 2 / (total_h - h + 1e-3) - base
                if gain > best[0]:
                    best = (gain, f, float(cut))
        if best[1] < 0:
            return value
        _, f, cut = best
        low, high = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
        return (f, cut, self._grow(x, grad, hess, low, depth - 1), self._grow(x, grad, hess, high, depth - 1))

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, float), np.asarray(y, float)
        rate = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.bias, self.trees = float(np.log(rate / (1 - rate))), []
        score = np.full(len(y), self.bias)
        for _ in range(self.rounds if len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(x, p - y, np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            score += self._apply(tree, x)
            if np.abs(p - y).max() < 0.02:
                break
        return self

    def _apply(self, node: Node, x: np.ndarray) -> np.ndarray:
        if isinstance(node, float):
            return np.full(len(x), node)
        f, cut, low, high = node
        return np.where(x[:, f] <= cut, self._apply(low, x), self._apply(high, x))

    def score(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        return self.bias + sum((self._apply(t, x) for t in self.trees), np.zeros(len(x)))

    def column(self, features: list[Column]) -> Column:
        """The score as an expression over feature columns (log-odds; above 0 means yes)."""

        def build(node: Node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            f, cut, low, high = node
            return F.when(features[f] <= cut, build(low)).otherwise(build(high))

        out = F.lit(self.bias)
        for tree in self.trees:
            out = out + build(tree)
        return out
