"""Gradient-boosted trees for two classes, by histograms in numpy; for bounded training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of one depth; each level splits by a feature's bin, leaves hold log-odds."""

    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.int64)
        for f, cut in enumerate(self.cuts):
            out[:, f] = np.searchsorted(cut, x[:, f], "left")
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        binned, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            out += leaf[_leaves(binned, rows, feature, cut)]
        return out


def _leaves(binned: np.ndarray, rows: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    depth, node = int(np.log2(len(feature) + 1)), np.zeros(len(rows), np.int64)
    for level in range(depth):
        at = (1 << level) - 1 + node
        node = 2 * node + (binned[rows, feature[at]] > cut[at])
    return node


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25, most: int = 32, ridge: float = 1.0) -> Boosted:
    """Fit by second-order boosting of the logistic loss."""
    model = Boosted()
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > most:
            values = np.unique(np.quantile(x[:, f], np.linspace(0, 1, most + 1)[1:-1]))
        model.cuts.append(values[:-1] if len(values) > 1 and len(values) <= most else values)
    binned, rows = model.bins(x), np.arange(len(x))
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model.start = float(np.log(share / (1 - share)))
    score, width = np.full(len(x), model.start), most + 2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        grad, curve = y - p, p * (1 - p)
        feature, cut = np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, width, np.int64)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            n = 1 << level
            gain = np.zeros((x.shape[1], n, width))
            for f in range(x.shape[1]):
                place = node * width + binned[:, f]
                g = np.bincount(place, grad, n * width).reshape(n, width).cumsum(1)
                h = np.bincount(place, curve, n * width).reshape(n, width).cumsum(1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                fits = (h > 1) & (whole_h - h > 1)
                split = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
                gain[f] = np.where(fits, split, 0)
            best = gain.transpose(1, 0, 2).reshape(n, -1).argmax(1)
            good = gain.transpose(1, 0, 2).reshape(n, -1)[np.arange(n), best] > 1e-6
            feature[n - 1 : 2 * n - 1] = best // width
            cut[n - 1 : 2 * n - 1] = np.where(good, best % width, width)
            at = n - 1 + node
            node = 2 * node + (binned[rows, feature[at]] > cut[at])
        leaves = 1 << depth
        leaf = rate * np.bincount(node, grad, leaves) / (np.bincount(node, curve, leaves) + ridge)
        model.trees.append((feature, cut, leaf))
        score += leaf[node]
    return model
