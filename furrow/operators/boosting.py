"""Gradient-boosted regression trees over binned features: fitted in memory on a bounded sample, applied everywhere."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Complete binary trees of one depth: feature and bin by inner node, value by leaf; a node that isn't split sends all to the left."""

    base: float
    edges: tuple[np.ndarray, ...]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.value.shape[1]))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (b[rows, self.feature[t, at]] > self.cut[t, at])
            out += self.value[t, at - (self.value.shape[1] - 1)]
        return out


def binned(x: np.ndarray, edges: tuple[np.ndarray, ...]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1).astype(np.int16)


def fit_boosting(x: np.ndarray, y: np.ndarray, trees: int = 400, depth: int = 5, rate: float = 0.05, rows: float = 0.8, columns: float = 0.8, bins: int = 64, ridge: float = 1.0, seed: int = 42) -> Boosted:
    """Squared loss; each tree sees a share of the rows and of the columns; a split must lower the ridge-penalised loss."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    edges = tuple(np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d))
    b = binned(x, edges)
    inner, leaves = 2**depth - 1, 2**depth
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), bins, np.int16), np.zeros((trees, leaves))
    base = float(y.mean())
    fit = np.full(n, base)
    for t in range(trees):
        use = np.sort(rng.choice(n, max(1, int(n * rows)), replace=False))
        some = np.sort(rng.choice(d, max(1, int(round(d * columns))), replace=False))
        g, bt = y[use] - fit[use], b[use]
        node = np.zeros(len(use), np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            best = np.full(width, 1e-12)
            for j in some:
                at = node * bins + bt[:, j]
                s, m = (np.bincount(at, weights=w, minlength=width * bins).reshape(width, bins) for w in (g, None))
                ls, lm = s.cumsum(1)[:, :-1], m.cumsum(1)[:, :-1]
                ts, tm = s.sum(1)[:, None], m.sum(1)[:, None]
                gain = ls**2 / (lm + ridge) + (ts - ls) ** 2 / (tm - lm + ridge) - ts**2 / (tm + ridge)
                gain[(lm < 1) | (tm - lm < 1)] = -1.0
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best = np.where(better, top, best)
                feature[t, first : first + width][better] = j
                cut[t, first : first + width][better] = k[better]
            node = 2 * node + (bt[np.arange(len(use)), feature[t, first + node]] > cut[t, first + node])
        s, m = np.bincount(node, weights=g, minlength=leaves), np.bincount(node, minlength=leaves)
        value[t] = rate * s / (m + ridge)
        at = np.zeros(n, np.int64)
        for _ in range(depth):
            at = 2 * at + 1 + (b[np.arange(n), feature[t, at]] > cut[t, at])
        fit += value[t, at - inner]
    return Boosted(base, edges, feature, cut, value)
