"""Gradient-boosted regression trees for binary labels, in numpy, on features cut to 32 bins."""

from __future__ import annotations

import numpy as np

BINS = 32


class Forest:
    """Trees as arrays: feature, cut, left, right, value."""

    def __init__(self, base: float, trees: list[tuple[np.ndarray, ...]], depth: int):
        self.base, self.trees, self.depth = base, trees, depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), np.int32)
            for _ in range(self.depth):  # a leaf leads to itself
                at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 30, depth: int = 4, rate: float = 0.25, ridge: float = 1.0) -> Forest:
    """Boost ``rounds`` trees of ``depth`` splits on the gradient of the logistic loss."""
    p = np.clip((y * weight).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(p / (1 - p)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    trees, base = [], float(score[0])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-score))
        g, h = (q - y) * weight, q * (1 - q) * weight
        feature, cut, left, right, value = [0], [0.0], [0], [0], [0.0]
        open_leaves = [(0, np.arange(len(y)), 0)]
        while open_leaves:
            node, rows, level = open_leaves.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            value[node] = -rate * gs / (hs + ridge)
            if level == depth or len(rows) < 20:
                continue
            best = (1e-6, -1, 0)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                gb = np.bincount(binned[rows, j], g[rows], len(c) + 1).cumsum()[:-1]
                hb = np.bincount(binned[rows, j], h[rows], len(c) + 1).cumsum()[:-1]
                gain = gb**2 / (hb + ridge) + (gs - gb) ** 2 / (hs - hb + ridge) - gs**2 / (hs + ridge)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], j, k)
            _, j, k = best
            if j < 0:
                continue
            below = binned[rows, j] <= k
            feature[node], cut[node] = j, float(cuts[j][k])
            for part, side in ((rows[below], left), (rows[~below], right)):
                side[node] = len(value)
                for column, start in ((feature, 0), (cut, 0.0), (left, len(value)), (right, len(value)), (value, 0.0)):
                    column.append(start)
                open_leaves.append((len(value) - 1, part, level + 1))
        tree = tuple(np.array(c, t) for c, t in ((feature, np.int32), (cut, float), (left, np.int32), (right, np.int32), (value, float)))
        score += Forest(0.0, [tree], depth).log_odds(x)
        trees.append(tree)
    return Forest(base, trees, depth)
