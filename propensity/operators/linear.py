"""Least squares and outlier distance from one pass of second moments.

The pass returns one row of k(k+1)/2 numbers; everything after it is a column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V
from propensity.operators.ordered import exact_quantiles


@dataclass(frozen=True)
class Moments:
    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    cov: np.ndarray


def moments(df: DataFrame, cols: Sequence[str]) -> Moments:
    """Means and sample covariances over complete rows."""
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = x.selectExpr("count(*) AS n", *[f"avg(`{c}`) AS m{i}" for i, c in enumerate(cols)],
                       *[f"covar_samp(`{cols[i]}`, `{cols[j]}`) AS c{i}_{j}" for i, j in pairs]).first()
    cov = np.zeros((len(cols), len(cols)))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    mean = np.array([row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i in range(len(cols))])
    return Moments(tuple(cols), row["n"], mean, cov)


def mahalanobis(df: DataFrame, cols: Sequence[str], out: str = "outlier_score") -> DataFrame:
    """Add the squared distance of each row from the mean under the sample covariance.

    A column without variance, or one that the others determine, adds nothing and is
    left out of the distance.
    """
    m = moments(df, cols)
    kept: list[int] = []
    for i in range(len(cols)):
        trial = kept + [i]
        block = m.cov[np.ix_(trial, trial)]
        sd = np.sqrt(np.diag(block))
        if (sd > 0).all() and np.linalg.eigvalsh(block / np.outer(sd, sd))[0] > 1e-10:
            kept = trial
    whiten = np.linalg.inv(np.linalg.cholesky(m.cov[np.ix_(kept, kept)])) if kept else np.zeros((0, 0))
    parts = []
    for r in range(len(kept)):
        z = " + ".join(f"{float(whiten[r, c])!r}D * (`{cols[kept[c]]}` - {float(m.mean[kept[c]])!r}D)"
                       for c in range(r + 1))
        parts.append(f"pow({z}, 2)")
    return df.withColumn(out, F.expr(" + ".join(parts) or "0D"))


def flag_outliers(df: DataFrame, score: str, quantile: float = V.OUTLIER_QUANTILE,
                  out: str = "is_suspicious") -> DataFrame:
    """1 where the score lies strictly above its quantile."""
    cut = exact_quantiles(df, score, {"q": quantile}).scalar()
    return df.withColumn(out, C.flag(F.col(score) > cut))


@dataclass(frozen=True)
class LinearFit:
    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        y = F.lit(self.intercept)
        for c, b in zip(self.columns, self.coefficients):
            y = y + F.lit(b) * F.col(c)
        return df.withColumn(out, y)


def least_squares(df: DataFrame, label: str, cols: Sequence[str]) -> LinearFit:
    m = moments(df, [*cols, label])
    k = len(cols)
    beta = np.linalg.lstsq(m.cov[:k, :k], m.cov[:k, k], rcond=None)[0]
    return LinearFit(tuple(cols), tuple(float(b) for b in beta),
                     float(m.mean[k] - beta @ m.mean[:k]))
