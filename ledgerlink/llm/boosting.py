"""Gradient-boosted trees for binary labels, small enough to travel with a job."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_BINS = 32


@dataclass
class BoostedTrees:
    """Full binary trees of equal depth over binned features; scores are log-odds."""

    cuts: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 4

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = self.binned(x)
        rows = np.arange(len(bins))
        out = np.full(len(bins), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(bins), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 4.0) -> BoostedTrees:
    """Boost the logistic loss by second-order steps; splits are found on histograms."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, _BINS)[1:-1])) for k in range(x.shape[1])]
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = BoostedTrees(cuts, float(np.log(mean / (1 - mean))), [], depth)
    bins = model.binned(x).astype(np.int64)
    score = np.full(len(y), model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        inner = (1 << depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, _BINS, np.int64)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            gains = np.zeros((width, x.shape[1], _BINS))
            for k in range(x.shape[1]):
                key = (node - first) * _BINS + bins[:, k]
                g = np.bincount(key, gradient, width * _BINS).reshape(width, _BINS).cumsum(axis=1)
                h = np.bincount(key, weight, width * _BINS).reshape(width, _BINS).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (g_all - g) ** 2 / (h_all - h + 1) - g_all**2 / (h_all + 1)
                gains[:, k] = np.where((h >= least) & (h_all - h >= least), gain, 0)
            best = gains.reshape(width, -1).argmax(axis=1)
            useful = gains.reshape(width, -1)[np.arange(width), best] > 1e-6
            feature[first : first + width] = np.where(useful, best // _BINS, 0)
            cut[first : first + width] = np.where(useful, best % _BINS, _BINS)
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        g = np.bincount(leaf, gradient, 1 << depth)
        h = np.bincount(leaf, weight, 1 << depth)
        value = rate * g / (h + 1)
        model.trees.append((feature, cut, value))
        score += value[leaf]
    return model
