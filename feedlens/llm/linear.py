"""Sparse linear models: follow-the-regularised-leader with elastic net.

Samples are (indexes, values, class); training runs over a bounded sample in
one process and is deterministic.
"""

from __future__ import annotations

import numpy as np

Sample = tuple[np.ndarray, np.ndarray, int]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(
    samples: list[Sample], dims: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05, epochs: int = 3, seed: int = 11,
    counts: np.ndarray | None = None,
) -> np.ndarray:
    """Weights (dims, classes) of a multinomial logistic regression.

    Per-coordinate FTRL-proximal: a weight is zero while its accumulated
    gradient is within ``l1``; ``l2`` shrinks the others.  ``counts`` weighs the
    samples' losses (1 each without it)."""
    z, n = np.zeros((dims, classes)), np.zeros((dims, classes))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            at, x, y = samples[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            p = softmax(x @ w)
            p[y] -= 1
            if counts is not None:
                p *= counts[i]
            g = x[:, None] * p
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / alpha * w
            n[at] = grown
    return weights(z, n)


def scores(samples: list[Sample], weights: np.ndarray) -> np.ndarray:
    return np.array([x @ weights[at] for at, x, _ in samples]).reshape(len(samples), weights.shape[1])


def temperature(logits: np.ndarray, classes: np.ndarray, low: float = -3.0, high: float = 3.0) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return float(-np.log(np.maximum(p[np.arange(len(p)), classes], 1e-300)).mean())

    ratio = (5**0.5 - 1) / 2
    a, b = low, high
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    for _ in range(60):
        if loss(c) <= loss(d):
            b, d = d, c
            c = b - ratio * (b - a)
        else:
            a, c = c, d
            d = a + ratio * (b - a)
    return float(np.exp((a + b) / 2))
