"""Gradient-boosted trees for a few classes, small enough to be broadcast."""

from __future__ import annotations

import numpy as np


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class BoostedTrees:
    """Multi-class gradient boosting on binned features; probabilities are calibrated by one temperature."""

    def __init__(self, classes: int, rounds: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 48, weight: float = 1.0):
        self.classes, self.rounds, self.depth, self.rate, self.bins, self.weight = classes, rounds, depth, rate, bins, weight
        self.trees: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.bias, self.temperature = np.zeros(classes), 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        half = np.linspace(0, 1, self.bins // 2 + 1)[1:-1]
        cuts = [np.unique(np.concatenate([np.quantile(x[:, j], half), x[:, j].min() + half * np.ptp(x[:, j])])) for j in range(width)]
        # Cuts lie between values, so that a threshold stands in the middle of a gap.
        cuts = [np.unique(self._middles(x[:, j], c)) for j, c in enumerate(cuts)]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
        onehot = np.eye(self.classes)[y]
        self.bias = np.log(onehot.mean(0) + 1e-3)
        z = np.tile(self.bias, (n, 1))
        for _ in range(self.rounds):
            p = _softmax(z)
            for k in range(self.classes):
                g, h = onehot[:, k] - p[:, k], np.maximum(p[:, k] * (1 - p[:, k]), 1e-6)
                feature, threshold, value, leaf = self._grow(binned, cuts, g, h)
                self.trees.append((k, feature, threshold, value))
                z[:, k] += value[leaf]
        return self

    @staticmethod
    def _middles(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        known = np.unique(values)
        at = np.searchsorted(known, cuts, "right")
        low, high = known[np.maximum(at - 1, 0)], known[np.minimum(at, len(known) - 1)]
        return (low + high) / 2

    def _grow(self, binned, cuts, g, h):
        n, width = binned.shape
        inner = (1 << self.depth) - 1
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            local = node - first
            best = np.full(count, 1e-6)
            for j in range(width):
                size = len(cuts[j]) + 1
                if size == 1:
                    continue
                key = local * size + binned[:, j]
                gs = np.bincount(key, g, count * size).reshape(count, size).cumsum(1)
                hs = np.bincount(key, h, count * size).reshape(count, size).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gl, hl = gs[:, :-1], hs[:, :-1]
                gain = gl**2 / (hl + self.weight) + (gt - gl) ** 2 / (ht - hl + self.weight) - gt**2 / (ht + self.weight)
                at = gain.argmax(1)
                top = gain[np.arange(count), at]
                better = top > best
                best = np.where(better, top, best)
                feature[first : first + count] = np.where(better, j, feature[first : first + count])
                threshold[first : first + count] = np.where(better, cuts[j][at], threshold[first : first + count])
            cut_bin = np.array([np.searchsorted(cuts[f], t, "left") if np.isfinite(t) else 1 << 30 for f, t in zip(feature, threshold)])
            right = binned[np.arange(n), feature[node]] > cut_bin[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        leaves = 1 << self.depth
        value = self.rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + self.weight)
        return feature, threshold, value, leaf

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.tile(self.bias, (len(x), 1))
        rows = np.arange(len(x))
        inner = (1 << self.depth) - 1
        for k, feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            z[:, k] += value[node - inner]
        return z

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Choose the temperature that gives the holdout the highest likelihood."""
        z = self.scores(x)
        grid = np.geomspace(0.25, 4, 33)
        loss = [-np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-9).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.scores(x) / self.temperature) if len(x) else np.zeros((0, self.classes))
