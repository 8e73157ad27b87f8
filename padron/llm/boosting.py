"""Gradient-boosted trees on a bounded table of numeric features, for tasks that score spans."""

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    start: float
    edges: list[np.ndarray]
    trees: list[list[tuple]]

    def margins(self, features: np.ndarray) -> np.ndarray:
        bins = _bins(features, self.edges)
        total = np.full(len(features), self.start)
        for tree in self.trees:
            total += _walk(tree, bins)
        return total

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(features), -60, 60)))


def _bins(features: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, features[:, j], side="right")
                     for j, e in enumerate(edges)], axis=1)


def _walk(tree: list[tuple], bins: np.ndarray) -> np.ndarray:
    """tree: nodes (feature, bin, left, right, value); feature -1 is a leaf."""
    at = np.zeros(len(bins), np.int64)
    feature = np.array([n[0] for n in tree])
    cut, left, right = (np.array([n[k] for n in tree]) for k in (1, 2, 3))
    value = np.array([n[4] for n in tree])
    rows = np.arange(len(bins))
    while len(bins) and (feature[at] >= 0).any():
        inner = feature[at] >= 0
        go = bins[rows, np.maximum(feature[at], 0)] <= cut[at]
        at = np.where(inner, np.where(go, left[at], right[at]), at)
    return value[at]


def boost(features: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 3,
          rate: float = 0.25, max_bins: int = 32) -> Boosted:
    """Logistic loss, Newton leaves, splits at quantiles of the features."""
    edges = [np.unique(np.quantile(features[:, j], np.linspace(0, 1, max_bins + 1)[1:-1]))
             for j in range(features.shape[1])]
    edges = [np.unique(np.append(e, (np.unique(f)[:-1] + np.unique(f)[1:]) / 2))
             if len(np.unique(f)) <= max_bins else e
             for e, f in zip(edges, features.T)]
    bins = _bins(features, edges)
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), edges, [])
    margin = np.full(len(labels), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = p - labels, p * (1 - p) + 1e-6
        tree: list[tuple] = []

        def grow(rows: np.ndarray, level: int) -> int:
            me = len(tree)
            g, h = gradient[rows].sum(), curve[rows].sum()
            tree.append((-1, 0, 0, 0, -rate * g / (h + 1)))
            best = (1e-3, None)
            for j in range(bins.shape[1] if level else 0):
                size = len(edges[j]) + 1
                gs = np.cumsum(np.bincount(bins[rows, j], gradient[rows], size))[:-1]
                hs = np.cumsum(np.bincount(bins[rows, j], curve[rows], size))[:-1]
                if len(gs):
                    gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k))
            if best[1]:
                j, k = best[1]
                low = bins[rows, j] <= k
                left, right = grow(rows[low], level - 1), grow(rows[~low], level - 1)
                tree[me] = (j, k, left, right, 0.0)
            return me

        grow(np.arange(len(labels)), depth)
        model.trees.append(tree)
        margin += _walk(tree, bins)
    return model


def precise_threshold(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """Lowest score from which on at least this share of the labelled rows is positive."""
    order = np.argsort(-scores, kind="stable")
    share = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    return float(scores[order][good[-1]]) if len(good) else 1.0
