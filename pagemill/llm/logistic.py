"""A small logistic regression that turns a few figures into a probability."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Logistic:
    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights + self.bias, -35.0, 35.0)))


def fit(x: np.ndarray, y: np.ndarray, rate: float, ridge: float = 1e-2, steps: int = 50) -> Logistic:
    """Newton's method. ``rate`` is the share of label 1 in all data: samples may hold the classes at other shares.

    With labels of one kind only, the answer is ``rate`` for every input.
    """
    n, d = x.shape if x.ndim == 2 else (0, 0)
    ones = int(y.sum())
    prior = float(np.log(rate / (1 - rate)))
    if not 0 < ones < n:
        return Logistic(np.zeros(d), prior)
    full = np.hstack([x, np.ones((n, 1))])
    w = np.zeros(d + 1)
    penalty = np.full(d + 1, ridge * n / 100)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(full @ w, -35.0, 35.0)))
        gradient = full.T @ (p - y) + penalty * w
        curve = (full * (p * (1 - p) + 1e-9)[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(w[:-1], float(w[-1]) + prior - float(np.log(ones / (n - ones))))
