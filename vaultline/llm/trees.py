"""Regression trees over binned features, grown on a bounded sample; a forest and a boosted sequence of them."""

from __future__ import annotations

import numpy as np

_BINS = 32


def _edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, f], np.linspace(0, 1, _BINS + 1)[1:-1])) for f in range(x.shape[1])]


class RegressionTree:
    """Splits rows to fit ``target`` in least squares; leaf value is sum(target) / (sum(weight) + l2)."""

    def __init__(self, x, target, weight, edges, depth, features, rng, l2=0.0, least=5):
        self.feature: list[int] = []
        self.threshold: list[float] = []
        self.child: list[list[int]] = []
        self.value: list[float] = []
        self._options = (edges, features, rng, l2, least)
        self._grow(x, target, weight, np.arange(len(x)), depth)
        del self._options

    def _grow(self, x, target, weight, rows, depth) -> int:
        edges, features, rng, l2, least = self._options
        node = len(self.value)
        total, mass = target[rows].sum(), weight[rows].sum()
        self.value.append(float(total / (mass + l2 + 1e-12)))
        self.feature.append(-1)
        self.threshold.append(0.0)
        self.child.append([0, 0])
        if depth == 0 or len(rows) < 2 * least:
            return node
        best = (1e-9, -1, 0.0)
        tried = rng.choice(x.shape[1], min(features, x.shape[1]), replace=False)
        for f in sorted(tried):
            if not len(edges[f]):
                continue
            bins = np.searchsorted(edges[f], x[rows, f], side="left")
            size = len(edges[f]) + 1
            left = np.cumsum(np.bincount(bins, target[rows], size))[:-1]
            left_mass = np.cumsum(np.bincount(bins, weight[rows], size))[:-1]
            left_rows = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            gain = (left ** 2 / (left_mass + l2 + 1e-12)
                    + (total - left) ** 2 / (np.maximum(mass - left_mass, 0) + l2 + 1e-12)
                    - total ** 2 / (mass + l2 + 1e-12))
            gain[(left_rows < least) | (len(rows) - left_rows < least)] = -1
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], int(f), float(edges[f][at]))
        if best[1] < 0:
            return node
        self.feature[node], self.threshold[node] = best[1], best[2]
        below = x[rows, best[1]] <= best[2]
        self.child[node] = [self._grow(x, target, weight, rows[below], depth - 1),
                            self._grow(x, target, weight, rows[~below], depth - 1)]
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        child, node = np.array(self.child), np.zeros(len(x), dtype=np.int64)
        while (inner := np.flatnonzero(feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = child[at, (x[inner, feature[at]] > threshold[at]).astype(int)]
        return np.array(self.value)[node]


class RandomForest:
    """Mean of trees grown on bootstrap rows with a random subset of features at each split."""

    def __init__(self, x, y, trees=25, depth=8, seed=11):
        rng = np.random.default_rng(seed)
        edges, features = _edges(x), max(1, int(np.ceil(np.sqrt(x.shape[1]))))
        self.trees = []
        for _ in range(trees):
            rows = rng.integers(0, len(x), len(x))
            self.trees.append(RegressionTree(x[rows], y[rows].astype(float), np.ones(len(x)), edges, depth,
                                             features, rng))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


class BoostedTrees:
    """Newton boosting of log-loss."""

    def __init__(self, x, y, trees=60, depth=4, rate=0.2, seed=11):
        rng, edges = np.random.default_rng(seed), _edges(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.rate, self.trees = float(np.log(share / (1 - share))), rate, []
        score = np.full(len(x), self.base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tree = RegressionTree(x, y - p, p * (1 - p), edges, depth, x.shape[1], rng, l2=1.0)
            self.trees.append(tree)
            score = score + rate * tree.predict(x)

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score = score + self.rate * tree.predict(x)
        return 1 / (1 + np.exp(-score))
