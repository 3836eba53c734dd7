"""Small linear models in numpy, and bounded stratified samples to fit them on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Sampled ids broadcast at most.
MAX_SHIPPED = 500_000


def bounded_sample(ids: DataFrame, stratum: Column, per_stratum: int, id_col: str = "doc_id") -> DataFrame:
    """Ids of at most ``per_stratum`` rows of every stratum: ids are hashed into that many
    cells and each cell keeps the id with the smallest second hash.

    One partially aggregated shuffle of ids; a stratum with most of the rows costs no task
    more than the others.  The same ids are chosen however the rows are partitioned."""
    cell = F.pmod(F.xxhash64(F.col(id_col)), F.lit(per_stratum))
    order = F.xxhash64(F.col(id_col), F.lit(1))
    return (ids.filter(F.col(id_col).isNotNull()).groupBy(stratum.alias("stratum"), cell.alias("cell"))
            .agg(F.min_by(id_col, order).alias(id_col)).select(id_col, "stratum"))


def rows_of(docs: DataFrame, chosen: DataFrame, how: str = "left_semi", id_col: str = "doc_id") -> DataFrame:
    """``docs`` joined with a bounded sample of ids, broadcast once their number is checked."""
    chosen = stored(chosen, "chosen")
    small = chosen.count() <= MAX_SHIPPED
    return docs.join(F.broadcast(chosen) if small else chosen, id_col, how)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def newton_sums(z: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the logistic loss of some rows; sums over rows, so those of
    parts of a table add up."""
    p = sigmoid(z @ w)
    return z.T @ (weight * (p - y)), (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z


class View:
    """L2-regularised logistic regression on columns of known mean and scale, fitted from
    Newton sums that may come from anywhere."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, l2: float = 1.0):
        self.mean, self.scale = mean, scale
        self.w = np.zeros(len(mean) + 1)
        self.ridge = np.full(len(self.w), l2)
        self.ridge[0] = 1e-3

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.w

    def step(self, w: np.ndarray, grad: np.ndarray, curve: np.ndarray) -> np.ndarray:
        step = np.linalg.solve(curve + np.diag(self.ridge), grad + self.ridge * w)
        return w - step * min(1.0, 5.0 / (np.abs(step).max() + 1e-9))

    def fit(self, sums, steps: int = 12) -> None:
        for _ in range(steps):
            self.w = self.step(self.w, *sums(self.w))


class Logistic:
    """L2-regularised logistic regression on standardised columns, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0,
                 steps: int = 12):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)])
        weight = np.ones(len(x)) if weight is None else weight
        self.w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], l2)
        ridge[0] = 1e-3
        for _ in range(steps):
            p = sigmoid(z @ self.w)
            grad = z.T @ (weight * (p - y)) + ridge * self.w
            curve = (z * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curve, grad)
            self.w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-9))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.w[0] + np.clip((x - self.mean) / self.scale, -8, 8) @ self.w[1:]
