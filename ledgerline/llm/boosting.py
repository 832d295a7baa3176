"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

import numpy as np


class Trees:
    """Boosted trees of a fixed depth; a node's children stand at 2k+1 and 2k+2."""

    def __init__(self, bins: int = 48, rounds: int = 80, depth: int = 6, rate: float = 0.2, ridge: float = 1.0, least: float = 4.0):
        self.bins, self.rounds, self.depth, self.rate, self.ridge, self.least = bins, rounds, depth, rate, ridge, least
        self.cuts: list[np.ndarray] = []
        self.feature: list[np.ndarray] = []
        self.bound: list[np.ndarray] = []
        self.value: list[np.ndarray] = []
        self.base = 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for k, cuts in enumerate(self.cuts):
            out[:, k] = np.searchsorted(cuts, x[:, k])
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        """Newton boosting of the log loss; each level's splits come from one histogram for each feature."""
        self.cuts = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T]
        b = self.binned(x).astype(np.int64)
        rate = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(rate / (1 - rate)))
        at = np.full(len(y), self.base)
        rng = np.random.default_rng(len(y))
        every = np.arange(len(y))

        def histograms(rows: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
            """Sums of g and h by feature, node and bin."""
            out = np.empty((2, len(some), width, self.bins))
            place = at * self.bins
            for k, f in enumerate(some):
                cell = place + b[rows, f]
                for side, v in enumerate((g, h)):
                    out[side, k] = np.bincount(cell, v[rows], width * self.bins).reshape(width, -1)
            return out

        for _ in range(self.rounds):
            # each tree looks at half of the features
            some = np.sort(rng.choice(b.shape[1], (b.shape[1] + 1) // 2, replace=False))
            p = 1 / (1 + np.exp(-at))
            g, h = y - p, p * (1 - p)
            inner = (1 << self.depth) - 1
            feature, bound = np.zeros(inner, np.int64), np.full(inner, 255)
            node = np.zeros(len(y), np.int64)
            sums = histograms(every, node, 1)
            for level in range(self.depth):
                lo, width = (1 << level) - 1, 1 << level
                total = sums[:, 0].sum(2)  # any feature's bins add up to the node
                left = sums.cumsum(3)
                right = total[:, None, :, None] - left
                gain = left[0] ** 2 / (left[1] + self.ridge) + right[0] ** 2 / (right[1] + self.ridge) - (total[0] ** 2 / (total[1] + self.ridge))[:, None]
                gain[(left[1] < self.least) | (right[1] < self.least)] = 0
                flat = gain.transpose(1, 0, 2).reshape(width, -1)
                top = flat.argmax(1)
                better = flat[np.arange(width), top] > 1e-6
                feature[lo : lo + width][better], bound[lo : lo + width][better] = some[top[better] // self.bins], top[better] % self.bins
                node = 2 * node + 1 + (b[every, feature[node]] > bound[node])
                if level + 1 < self.depth:
                    # only the smaller child of each node is counted; the other is what is left of the node
                    child = node - (2 * width - 1)
                    size = np.bincount(child, minlength=2 * width).reshape(width, 2)
                    small = np.arange(0, 2 * width, 2) + (size[:, 1] < size[:, 0])
                    rows = np.flatnonzero(child == small[child // 2])
                    part = histograms(rows, child[rows] // 2, width)
                    both = np.empty((2, len(some), 2 * width, self.bins))
                    both[:, :, small], both[:, :, small ^ 1] = part, sums - part
                    sums = both
            leaf = node - inner
            value = self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.ridge)
            at += value[leaf]
            self.feature.append(feature)
            self.bound.append(bound)
            self.value.append(value)
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        out, inner, row = np.full(len(x), self.base), (1 << self.depth) - 1, np.arange(len(x))
        for feature, bound, value in zip(self.feature, self.bound, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[row, feature[node]] > bound[node])
            out += value[node - inner]
        return out
