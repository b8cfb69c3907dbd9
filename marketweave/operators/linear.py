"""Linear return models from Gram statistics.

One aggregate over the training rows gives their number and the means, variances and
covariances of features and label (partial central moments per task, one row in all). Least
squares, ridge, lasso and elastic net are solved from those few numbers: however many rows
there are, they are read once for all models, and no fit iterates over them.

All models minimise ``|y - Xb|^2 / (2n) + lam * (alpha |b|_1 + (1 - alpha) / 2 |b|^2)`` over
standardised features and label (population deviation; a feature or label that does not
vary gets coefficients of 0).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameters of the models: penalty and the share of it on absolute sizes.
PENALTIES = {"linear": (0.0, 0.0), "ridge": (0.1, 0.0), "lasso": (0.01, 1.0), "elastic_net": (0.05, 0.5)}
MAX_SWEEPS = 100_000
SETTLED = 1e-13


@dataclass(frozen=True)
class Gram:
    """Means and covariances (population) of the features and, last, the label."""

    n: int
    mean: np.ndarray
    cov: np.ndarray


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]

    def prediction(self) -> Column:
        out = F.lit(self.intercept)
        for c, b in zip(self.features, self.coefficients):
            out = out + F.lit(b) * F.col(c)
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their ``prediction``."""
        return rows.withColumn("prediction", self.prediction())


def gram(rows: DataFrame, features: Sequence[str], label: str = "label") -> Gram:
    """The statistics of ``rows`` without nulls in the named columns (no rows: zeros)."""
    cols = [*features, label]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    r = rows.na.drop(subset=cols).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean"),
        F.array(*[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).alias("cov")).first()
    cov = np.zeros((len(cols), len(cols)))
    for (i, j), v in zip(pairs, r["cov"]):
        cov[i, j] = cov[j, i] = v or 0.0
    return Gram(r["n"], np.array([m or 0.0 for m in r["mean"]]), cov)


def solve(g: Gram, lam: float, alpha: float) -> np.ndarray:
    """Coefficients over standardised features: in closed form without an absolute penalty (the
    shortest solution where features repeat each other), else by coordinate descent."""
    sd = np.sqrt(np.diag(g.cov))
    vary = sd > 0
    unit = np.where(vary, sd, 1.0)
    corr = g.cov / np.outer(unit, unit)
    a, c = corr[:-1, :-1], corr[:-1, -1]
    if not alpha:
        return np.linalg.lstsq(a + lam * np.eye(len(c)), c, rcond=1e-12)[0] * vary[:-1]
    b = np.zeros(len(c))
    for _ in range(MAX_SWEEPS):
        old = b.copy()
        for j in np.flatnonzero(vary[:-1]):
            rho = c[j] - a[j] @ b + a[j, j] * b[j]
            b[j] = np.sign(rho) * max(abs(rho) - lam * alpha, 0.0) / (a[j, j] + lam * (1 - alpha))
        if np.abs(b - old).max(initial=0.0) < SETTLED:
            return b
    raise RuntimeError("coordinate descent did not settle")


def fit(g: Gram, features: Sequence[str], name: str) -> LinearModel:
    """The named model in the units of features and label."""
    sd = np.sqrt(np.diag(g.cov))
    b = solve(g, *PENALTIES[name]) * sd[-1] / np.where(sd[:-1] > 0, sd[:-1], 1.0)
    return LinearModel(tuple(features), float(g.mean[-1] - b @ g.mean[:-1]), tuple(map(float, b)))


def coefficients(models: dict[str, LinearModel], like: DataFrame) -> DataFrame:
    """``(model, feature, coefficient)`` of linear models, the intercept included."""
    rows = [(name, f, b) for name, m in models.items()
            for f, b in (("intercept", m.intercept), *zip(m.features, m.coefficients))]
    return like.sparkSession.createDataFrame(rows, "model string, feature string, coefficient double")
