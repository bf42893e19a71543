"""Logistic regression on bounded samples, and the sampling of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights and, last, the intercept, by Newton steps; the intercept is not shrunk."""
    x = np.column_stack((x, np.ones(len(x)))).astype(np.float64)
    w = np.zeros(x.shape[1])
    w[-1] = logit(np.array((y.sum() + 0.5) / (len(y) + 1)))
    shrink = np.full(len(w), ridge)
    shrink[-1] = 1e-6
    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + (shrink * w * w).sum() / 2)

    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + shrink * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(shrink)
        change = np.linalg.solve(curve, slope)
        # A full step can go too far where the classes are apart: halve it until the loss falls.
        for _ in range(20):
            after = loss(w - change)
            if after <= now:
                break
            change = change / 2
        w, gain, now = w - change, now - after, after
        if gain < 1e-6 * max(1.0, now):
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def first_by_hash(ids: DataFrame, id_col: str, most: int) -> DataFrame:
    """At most `most` rows, in the order of a hash of their id: the same rows in every run."""
    order = F.xxhash64(F.col(id_col).cast("string"))
    return ids.orderBy(order, id_col).limit(most)
