"""Logistic regression on sparse 0/1 features, small enough for one process: the learned sample is bounded."""

from __future__ import annotations

import numpy as np


class Sparse:
    """Rows as lists of feature ids below width, each feature with the value 1 or the one given."""

    def __init__(self, rows: list, width: int, values: list | None = None):
        lengths = np.array([len(r) for r in rows], np.int64)
        some = len(rows) and lengths.sum()
        self.row = np.repeat(np.arange(len(rows)), lengths)
        self.col = np.concatenate([np.asarray(r, np.int64) for r in rows]) if some else np.zeros(0, np.int64)
        self.value = np.concatenate(values) if values and some else np.ones(len(self.col))
        self.n, self.width = len(rows), width

    @classmethod
    def of(cls, row: np.ndarray, col: np.ndarray, value: np.ndarray, n: int, width: int) -> Sparse:
        """From cells, without lists of rows."""
        out = cls([], width)
        out.row, out.col, out.value, out.n = row, col, value, n
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col] * self.value, minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=r[self.row] * self.value, minlength=self.width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def loss(w: np.ndarray, x: Sparse, y: np.ndarray, weight: np.ndarray, l2: float, pairs: tuple[Sparse, Sparse] | None, pair_weight: float, offset: np.ndarray | float = 0.0) -> tuple[float, np.ndarray]:
    """Weighted log-loss of w (the bias last) on top of the logits offset, l2/2 times the squared weights and pair_weight times the mean squared difference of the pairs' logits; and the gradient."""
    z = x.dot(w[:-1]) + w[-1] + offset
    r = weight * (sigmoid(z) - y)
    value = float((weight * (np.logaddexp(0, z) - y * z)).sum() + l2 / 2 * (w[:-1] ** 2).sum())
    g = np.append(x.back(r) + l2 * w[:-1], r.sum())
    if pairs and pairs[0].n:
        d = pairs[0].dot(w[:-1]) - pairs[1].dot(w[:-1])
        value += float(pair_weight * (d * d).mean())
        g[:-1] += (pairs[0].back(d) - pairs[1].back(d)) * (2 * pair_weight / pairs[0].n)
    return value, g


def fit(x: Sparse, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-3, pairs: tuple[Sparse, Sparse] | None = None, pair_weight: float = 1.0, steps: int = 300, rate: float = 0.2, offset: np.ndarray | float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and bias that lower loss() by Adam over all rows."""
    weight = np.ones(x.n) if weight is None else weight
    weight = weight / max(weight.sum(), 1e-12)
    w, mean, square = np.zeros(x.width + 1), np.zeros(x.width + 1), np.zeros(x.width + 1)
    for t in range(1, steps + 1):
        _, g = loss(w, x, y, weight, l2, pairs, pair_weight, offset)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8) / (1 + t / steps)
    return w[:-1], float(w[-1])
