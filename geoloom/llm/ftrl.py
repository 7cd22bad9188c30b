"""Follow-the-regularised-leader for sparse multinomial logistic regression."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows, targets, size: int, classes: int, *, alpha=0.5, beta=1.0, l1=0.0, l2=0.0, epochs=2, seed=7) -> np.ndarray:
    """Weights (size + 1, classes), the last row the bias, from (indexes, values) rows and class numbers.

    Elastic net: ``l1`` keeps weights at zero until their gradients outgrow it, ``l2``
    shrinks the rest. Each coordinate has its own step, which falls with its gradients.
    """
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))
    order = np.random.default_rng(seed)
    first, second = np.full((size + 1, 1), l1), np.full((size + 1, 1), l2)
    first[size] = second[size] = 0.0  # the bias is free

    def weights(at):
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * first[at]) / ((beta + np.sqrt(ni)) / alpha + second[at])
        return np.where(np.abs(zi) <= first[at], 0.0, w)

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at, size), np.append(x, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[targets[i]] -= 1.0
            g = x[:, None] * p[None, :]
            ni = n[at]
            total = ni + g * g
            z[at] += g - (np.sqrt(total) - np.sqrt(ni)) / alpha * w
            n[at] = total
    return weights(np.arange(size + 1))


def scores(rows, w: np.ndarray) -> np.ndarray:
    """Linear scores of (indexes, values) rows."""
    if not rows:
        return np.zeros((0, w.shape[1]))
    return np.stack([x @ w[at] + w[-1] for at, x in rows])


def temperature(z: np.ndarray, targets: np.ndarray) -> float:
    """The divisor of scores that gives held-back rows the greatest likelihood."""
    if not len(z):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(z)), targets], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])
