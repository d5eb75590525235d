"""Logistic regression on sparse rows, small enough for the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Sparse rows: ``index`` and ``value`` one row after another, ``bounds`` between them."""

    def __init__(self, index, value, bounds, width: int):
        self.index, self.value = np.asarray(index, np.int64), np.asarray(value, np.float64)
        self.bounds, self.width = np.asarray(bounds, np.int64), width
        self.row = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.index], len(self))

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, self.value * r[self.row], self.width)

    def take(self, keep: np.ndarray) -> "Rows":
        """The rows where ``keep`` holds."""
        own = keep[self.row]
        sizes = np.diff(self.bounds)[keep]
        return Rows(self.index[own], self.value[own], np.concatenate(([0], np.cumsum(sizes))), self.width)


    def only(self, columns: np.ndarray) -> "Rows":
        """The same rows with the entries of some columns."""
        own = columns[self.index] if len(self.index) else np.zeros(0, bool)
        sizes = np.bincount(self.row[own], minlength=len(self))
        return Rows(self.index[own], self.value[own], np.concatenate(([0], np.cumsum(sizes))), self.width)


def fit(rows: Rows, dense: np.ndarray, y: np.ndarray, l2: float, steps: int = 150) -> np.ndarray:
    """Weights of the sparse columns, then of the dense ones, then the bias.

    Full gradient steps with per-weight scaling; the loss is convex, so the start does not matter.
    """
    n, extra = max(1, len(rows)), dense.shape[1]
    w, m, v = (np.zeros(rows.width + extra + 1) for _ in range(3))
    if 0 < y.mean() < 1:
        w[-1] = np.log(y.mean() / (1 - y.mean()))
    else:  # one class only: a constant
        w[-1] = 8.0 if len(y) and y.mean() == 1 else -8.0
        return w
    for t in range(1, steps + 1):
        r = (sigmoid(rows.dot(w[: rows.width]) + dense @ w[rows.width : -1] + w[-1]) - y) / n
        g = np.concatenate((rows.back(r), dense.T @ r, [r.sum()]))
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9) * (1 - t / (steps + 1))
    return w


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is a calibrated probability.

    Targets are drawn in from 0 and 1 by the class counts, and Newton steps are damped.
    """
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))

    def loss(a, b):
        z = a * score + b
        return float((np.logaddexp(0, z) - target * z).sum())

    a, b = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(a * score + b)
        g = np.array([((p - target) * score).sum(), (p - target).sum()])
        q = p * (1 - p)
        h = np.array([[(q * score * score).sum(), (q * score).sum()], [(q * score).sum(), q.sum()]])
        step = np.linalg.solve(h + 1e-6 * len(y) * np.eye(2), g)
        now = loss(a, b)
        while np.abs(step).max() > 1e-7 and loss(a - step[0], b - step[1]) > now:
            step = step / 2
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)
