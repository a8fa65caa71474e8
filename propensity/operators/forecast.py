"""Seasonal ARIMA(p, d, q) with one seasonal AR term, fitted for many series at once.

Two-stage conditional least squares. Spark builds lags, residuals and the second moments
of every (series, d) group; only the small moment row of a group is solved in Python.
Input is one row per series and week, so a series never exceeds the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions import fixed_values as V
from propensity.operators.series import add_lags, difference

SEASON = V.SEASON_WEEKS
LONG_AR = 4  # lags of the first-stage regression
# The searched orders.
ORDERS = [(p, d, q) for p in range(3) for d in range(2) for q in range(3)]
COEFS = ["const", "phi1", "phi2", "phi_season", "theta1", "theta2"]


def regular_weeks(df: DataFrame) -> DataFrame:
    """Every week between a series' first and last one; a week without rows counts 0."""
    span = df.groupBy("series").agg(F.min("week").alias("lo"), F.max("week").alias("hi"))
    weeks = span.select("series", F.explode(
        F.sequence("lo", "hi", F.expr("interval 7 days"))).alias("week"))
    return weeks.join(df, ["series", "week"], "left").select(
        "series", "week", F.coalesce("y", F.lit(0)).cast("double").alias("y"))


def _moments(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    x = df.dropna(subset=cols)
    k = range(len(cols))
    return x.groupBy(*keys).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean"),
        F.array(*[F.covar_samp(cols[i], cols[j]) for i in k for j in k]).alias("cov"))


def solve(n: int, mean, cov, used: list[int]) -> tuple[np.ndarray, float, float] | None:
    """(coefficients, intercept, residual variance) of column 0 on the used columns."""
    m, c = np.asarray(mean, float), np.asarray(cov, float).reshape(len(mean), len(mean))
    a = c[np.ix_(used, used)]
    if n <= len(used) + 2 or (used and np.linalg.cond(a) > 1e10):
        return None
    beta = np.linalg.solve(a, c[used, 0]) if used else np.zeros(0)
    sse = (n - 1) * (c[0, 0] - beta @ c[used, 0])
    return beta, float(m[0] - beta @ m[used]), float(max(sse, 1e-12) / n)


def _stage_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            fit = solve(r.n, r.mean, r.cov, list(range(1, LONG_AR + 2)))
            if fit is not None:
                rows.append((r.series, r.d, fit[1], fit[0].tolist()))
        yield pd.DataFrame(rows, columns=["series", "d", "a0", "a"])


def _stage_two(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            for p, d, q in ORDERS:
                if d != r.d:
                    continue
                used = list(range(1, p + 1)) + [3] + list(range(4, 4 + q))
                fit = solve(r.n, r.mean, r.cov, used)
                if fit is None:
                    continue
                full = np.zeros(6)
                full[used] = fit[0]
                aic = r.n * np.log(fit[2]) + 2 * (len(used) + 2)
                rows.append((r.series, p, d, q, float(aic), fit[2], fit[1], *full[1:]))
        yield pd.DataFrame(rows, columns=["series", "p", "d", "q", "aic", "sigma2", *COEFS])


def with_residuals(df: DataFrame) -> DataFrame:
    """(series, week, d, y, w, e): differenced values and first-stage residuals."""
    weeks = regular_weeks(df)
    both = reduce(DataFrame.unionByName, [
        (difference(weeks, "series", "week", "y", d, "w") if d else weeks.withColumn("w", F.col("y")))
        .withColumn("d", F.lit(d)).withColumn("sid", F.concat_ws("|", "series", F.lit(d)))
        for d in (0, 1)]).filter(F.col("w").isNotNull())
    lags = [*range(1, LONG_AR + 1), SEASON]
    wide = add_lags(both, "sid", "week", "w", lags)
    cols = ["w", *[f"w_lag{k}" for k in lags]]
    fits = _moments(wide, ["series", "d"], cols).mapInPandas(
        _stage_one, "series string, d int, a0 double, a array<double>")
    fitted = wide.join(fits, ["series", "d"])
    guess = F.col("a0")
    for i, c in enumerate(cols[1:]):
        guess = guess + F.col("a")[i] * F.col(c)
    return fitted.select("series", "week", "d", "sid", "y", "w", "w_lag1", "w_lag2",
                         f"w_lag{SEASON}", (F.col("w") - guess).alias("e"))


def order_search(df: DataFrame) -> DataFrame:
    """All orders with their AIC and coefficients; the smallest AIC per series is marked."""
    rows = add_lags(with_residuals(df), "sid", "week", "e", [1, 2])
    cols = ["w", "w_lag1", "w_lag2", f"w_lag{SEASON}", "e_lag1", "e_lag2"]
    fits = _moments(rows, ["series", "d"], cols).mapInPandas(
        _stage_two, "series string, p int, d int, q int, aic double, sigma2 double, "
                    + ", ".join(f"{c} double" for c in COEFS))
    rank = F.row_number().over(Window.partitionBy("series").orderBy("aic", "p", "d", "q"))
    return fits.withColumn("is_best", rank == 1)


def step_ahead(w: np.ndarray, e: np.ndarray, coef: dict[str, float], steps: int) -> np.ndarray:
    """Forecasts of the differenced series; future shocks are zero."""
    w, e = list(w), list(e)
    for _ in range(steps):
        at = lambda xs, k: xs[-k] if len(xs) >= k else 0.0
        w.append(coef["const"] + coef["phi1"] * at(w, 1) + coef["phi2"] * at(w, 2)
                 + coef["phi_season"] * at(w, SEASON)
                 + coef["theta1"] * at(e, 1) + coef["theta2"] * at(e, 2))
        e.append(0.0)
    return np.array(w[-steps:])


def spread(coef: dict[str, float], d: int, steps: int) -> np.ndarray:
    """Square root of the sum of squared psi weights for 1..steps ahead."""
    psi = [1.0]
    for j in range(1, steps):
        v = coef["theta1"] if j == 1 else coef["theta2"] if j == 2 else 0.0
        v += coef["phi1"] * psi[j - 1]
        v += coef["phi2"] * psi[j - 2] if j >= 2 else 0.0
        v += coef["phi_season"] * psi[j - SEASON] if j >= SEASON else 0.0
        psi.append(v)
    psi = np.cumsum(psi) if d else np.array(psi)
    return np.sqrt(np.cumsum(psi ** 2))


def forecast(df: DataFrame, steps: int = 12) -> DataFrame:
    """Rounded forecasts with 95 % bounds for each series under its best order."""
    best = order_search(df).filter("is_best").drop("is_best", "p", "q", "aic")
    rows = with_residuals(df).select("series", "week", "d", "y", "w", "e")

    def extend(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week")
        last = pdf.iloc[-1]
        coef = {c: float(last[c]) for c in COEFS}
        d = int(last["d"])
        ahead = step_ahead(pdf["w"].to_numpy(), pdf["e"].fillna(0.0).to_numpy(), coef, steps)
        mean = last["y"] + np.cumsum(ahead) if d else ahead
        half = V.FORECAST_Z * np.sqrt(last["sigma2"]) * spread(coef, d, steps)
        return pd.DataFrame({"series": last["series"], "step": np.arange(1, steps + 1, dtype="int32"),
                             "forecast": np.round(mean), "lower_95": np.round(mean - half),
                             "upper_95": np.round(mean + half)})

    return rows.join(best, ["series", "d"]).groupBy("series").applyInPandas(
        extend, "series string, step int, forecast double, lower_95 double, upper_95 double")
