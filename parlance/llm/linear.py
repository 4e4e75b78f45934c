"""Linear models on hashed sparse features, fitted with numpy on a bounded sample."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: ``idx``/``val`` of all rows after each other, ``begin`` where each starts.
    Every row has at least one entry (the bias feature 0)."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], dims: int):
        self.idx = np.concatenate([i for i, _ in rows]).astype(np.int64)
        self.val = np.concatenate([v for _, v in rows]).astype(np.float64)
        sizes = np.array([len(i) for i, _ in rows])
        self.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.row = np.repeat(np.arange(len(rows)), sizes)
        self.dims = dims

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.idx] * self.val, self.begin)

    def pull(self, g: np.ndarray) -> np.ndarray:
        """Gradient by feature from the gradient by row."""
        return np.bincount(self.idx, weights=self.val * g[self.row], minlength=self.dims)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Adam:
    def __init__(self, dims: int, rate: float):
        self.m, self.v, self.rate, self.t = np.zeros(dims), np.zeros(dims), rate, 0

    def step(self, w: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        w -= self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-9)


def fit_logistic(x: Rows, y: np.ndarray, l2: float = 1e-5, rate: float = 0.05, steps: int = 120) -> np.ndarray:
    """Class-balanced logistic regression."""
    w = np.zeros(x.dims)
    pos = max(1, int(y.sum()))
    neg = max(1, len(y) - int(y.sum()))
    weight = np.where(y == 1, 0.5 / pos, 0.5 / neg)
    opt = Adam(x.dims, rate)
    for _ in range(steps):
        g = x.pull((sigmoid(x.scores(w)) - y) * weight) + l2 * w
        opt.step(w, g)
    return w


def fit_platt(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(a, b) with P(1 | s) = sigmoid(a s + b): Newton steps on Platt's smoothed targets."""
    n1 = int(y.sum())
    n0 = len(y) - n1
    if n1 == 0 or n0 == 0:
        return 1.0, 0.0
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * score + b)
        r = p - t
        h = np.maximum(p * (1 - p), 1e-6)
        ga, gb = (r * score).sum(), r.sum()
        haa, hab, hbb = (h * score * score).sum() + 1e-6, (h * score).sum(), h.sum() + 1e-6
        det = haa * hbb - hab * hab
        if det < 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
    return float(a), float(b)


def fit_nnpu(pos: Rows, unl: Rows, prior: float, l2: float = 1e-5, rate: float = 0.05, steps: int = 200) -> np.ndarray:
    """Non-negative positive-unlabelled learning (logistic loss). The risk of the negatives,
    R_U(-) - prior * R_P(-), is an estimate of a non-negative number; while it is negative, the
    step goes against it alone, which undoes overfitting."""
    w = np.zeros(pos.dims)
    opt = Adam(pos.dims, rate)
    n_p, n_u = len(pos.begin), len(unl.begin)
    for _ in range(steps):
        zp, zu = pos.scores(w), unl.scores(w)
        neg_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        down = unl.pull(sigmoid(zu) / n_u) - prior * pos.pull(sigmoid(zp) / n_p)
        if neg_risk >= 0:
            g = down - prior * pos.pull((1 - sigmoid(zp)) / n_p)
        else:
            g = -down
        opt.step(w, g + l2 * w)
    return w
