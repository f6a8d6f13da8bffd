"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, trees of fixed depth grown level by level over quantile bins; deterministic."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        inner = 2**self.depth - 1
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(n, self.base)
        self.feature = np.zeros((self.trees, inner), np.int32)
        self.cut = np.full((self.trees, inner), np.inf)
        self.value = np.zeros((self.trees, inner + 1))
        columns = np.arange(width) * self.bins
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            at = np.zeros(n, np.int64)  # node within the level
            for level in range(self.depth):
                nodes = 2**level
                slot = (at[:, None] * (width * self.bins) + columns + binned).ravel()
                shape = (nodes, width, self.bins)
                sg = np.bincount(slot, np.repeat(g, width), nodes * width * self.bins).reshape(shape).cumsum(axis=2)
                sh = np.bincount(slot, np.repeat(h, width), nodes * width * self.bins).reshape(shape).cumsum(axis=2)
                tg, th = sg[:, :1, -1:], sh[:, :1, -1:]
                gain = sg**2 / (sh + self.ridge) + (tg - sg) ** 2 / (th - sh + self.ridge) - tg**2 / (th + self.ridge)
                gain[(sh < 1e-3) | (th - sh < 1e-3)] = 0
                best = gain.reshape(nodes, -1).argmax(axis=1)
                f, b = best // self.bins, best % self.bins
                for k in range(nodes):
                    if gain[k, f[k], b[k]] > 1e-9 and b[k] < len(cuts[f[k]]):
                        self.feature[t, nodes - 1 + k], self.cut[t, nodes - 1 + k] = f[k], cuts[f[k]][b[k]]
                index = nodes - 1 + at
                at = 2 * at + (x[np.arange(n), self.feature[t, index]] > self.cut[t, index])
            sg, sh = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
            self.value[t] = self.rate * sg / (sh + self.ridge)
            margin += self.value[t][at]
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        rows, margin = np.arange(len(x)), np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                index = 2**level - 1 + at
                at = 2 * at + (x[rows, feature[index]] > cut[index])
            margin += value[at]
        return 1 / (1 + np.exp(-margin))
