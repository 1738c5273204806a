"""Small tree models in numpy: one classification tree, boosted trees, isotonic calibration."""

from __future__ import annotations

import numpy as np


class DecisionTree:
    """A binary classification tree grown by Gini impurity over all thresholds; for small tables."""

    def __init__(self, x, y, depth: int = 6, least: int = 1):
        self.nodes: list[tuple] = []
        self._grow(np.asarray(x, float), np.asarray(y, float), depth, least)

    def _grow(self, x, y, depth, least) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, 0, 0, float(y.mean())))
        p = y.mean()
        best = (p * (1 - p) * len(y) - 1e-9, None)
        if depth and 0 < p < 1:
            for f in range(x.shape[1]):
                v = np.unique(x[:, f])
                for cut in (v[1:] + v[:-1]) / 2:
                    left = x[:, f] <= cut
                    if min(left.sum(), (~left).sum()) >= least:
                        cost = sum(m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (left, ~left))
                        if cost < best[0]:
                            best = (cost, (f, cut, left))
        if best[1]:
            f, cut, left = best[1]
            a = self._grow(x[left], y[left], depth - 1, least)
            b = self._grow(x[~left], y[~left], depth - 1, least)
            self.nodes[at] = (f, float(cut), a, b, float(p))
        return at

    def __call__(self, row) -> float:
        f, cut, a, b, p = self.nodes[0]
        while f >= 0:
            f, cut, a, b, p = self.nodes[a if row[f] <= cut else b]
        return p


class BoostedTrees:
    """Gradient-boosted trees for 0/1 labels: logistic loss, quantile bins, level-wise growth, Newton leaves."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 3, rate: float = 0.1, bins: int = 48, l2: float = 2.0, least: float = 2.0):
        n, m = x.shape
        self.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) if n else np.zeros(0) for f in range(m)]
        codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(self.cuts)], 1).astype(np.int64)
        self.base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
        self.rate, self.depth, self.forest = rate, depth, []
        margin = np.full(n, self.base)
        width = bins + 1
        offset = (np.arange(m) * width)[None, :]
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, cut = np.full((1 << depth) - 1, -1), np.zeros((1 << depth) - 1)
            for level in range(depth):
                first, k = (1 << level) - 1, 1 << level
                place = ((node - first)[:, None] * (m * width) + offset + codes).ravel()
                gs = np.bincount(place, np.repeat(g, m), k * m * width).reshape(k, m, width).cumsum(2)
                hs = np.bincount(place, np.repeat(h, m), k * m * width).reshape(k, m, width).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                gain[(hs < least / 4) | (ht - hs < least / 4)] = -1
                best = gain.reshape(k, -1).argmax(1)
                f, c = best // width, best % width
                ok = gain.reshape(k, -1)[np.arange(k), best] > 1e-6
                for i in range(k):
                    feature[first + i] = f[i] if ok[i] and c[i] < len(self.cuts[f[i]]) else -1
                    cut[first + i] = self.cuts[f[i]][c[i]] if feature[first + i] >= 0 else 0.0
                fi, ci = feature[node], cut[node]
                right = (fi >= 0) & (x[np.arange(n), np.maximum(fi, 0)] > ci)
                node = 2 * node + 1 + right
            leaf = node - ((1 << depth) - 1)
            value = np.bincount(leaf, g, 1 << depth) / (np.bincount(leaf, h, 1 << depth) + l2) * rate
            self.forest.append((feature, cut, value))
            margin += value[leaf]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.forest:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                node = 2 * node + 1 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > cut[node]))
            out += value[node - len(feature)]
        return out


class Isotonic:
    """Pool-adjacent-violators fit of labels on margins, read by interpolation between the pools' centres."""

    def __init__(self, margin: np.ndarray, y: np.ndarray):
        order = np.argsort(margin, kind="stable")
        pools: list[list[float]] = []  # weight, sum of labels, sum of margins
        for m, t in zip(margin[order], y[order]):
            pools.append([1.0, float(t), float(m)])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                a = pools.pop()
                pools[-1] = [u + v for u, v in zip(pools[-1], a)]
        self.at = np.array([p[2] / p[0] for p in pools])
        # a pool's mean is drawn in from 0 and 1, so that order within the outermost pools is kept
        self.value = np.array([(p[1] + 0.25) / (p[0] + 0.5) for p in pools])
        self.value = np.maximum.accumulate(self.value)

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        inner = np.interp(margin, self.at, self.value)
        low, high = self.at[0] - margin, margin - self.at[-1]
        inner = np.where(low > 0, self.value[0] * np.exp(-np.maximum(low, 0)), inner)
        return np.where(high > 0, 1 - (1 - self.value[-1]) * np.exp(-np.maximum(high, 0)), inner)


class Constant:
    """A calibration without anything to calibrate on."""

    def __init__(self, value: float):
        self.value = value

    def __call__(self, margins) -> np.ndarray:
        return np.full(len(margins), self.value)
