"""Penalised logistic regression along a path of penalties, with cross-validation, for many fits in step.

Each outer step needs one pass over the rows: per fit and penalty the weighted second moments of the columns
and their products with the residual. The penalised step is solved on these moments by coordinate descent, for all fits and
penalties at once. Moments are added up by fit on the executors: what reaches the driver is fits x penalties x columns squared a step, whatever
the number of rows and partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators.boosting import Binned, added, part_size

SCORE_BINS = 1024  # the area under the curve that chooses a penalty counts scores in so many bins
CHUNK = 512  # rows whose products fit a cache


@dataclass(frozen=True)
class LinearScore:
    """Logistic score of the `features` vector."""
    intercept: float
    coefficients: np.ndarray
    penalty: float

    def score(self, df: DataFrame, name: str = "prob", features: str = "features") -> DataFrame:
        b = F.array(*[F.lit(float(v)) for v in self.coefficients])
        terms = F.zip_with(vector_to_array(features), b, lambda x, v: x * v)
        return df.withColumn(name, C.logistic(F.aggregate(terms, F.lit(self.intercept), lambda acc, t: acc + t)))


@dataclass(frozen=True)
class Path:
    """Penalties from large to small, with mean and standard error of the area under the curve over the folds."""
    penalties: np.ndarray
    auc: np.ndarray
    error: np.ndarray
    intercepts: np.ndarray
    coefficients: np.ndarray  # penalties x columns

    @property
    def smallest(self) -> int:
        """The penalty with the largest mean area; of equal ones the largest."""
        return int(np.argmax(np.round(self.auc, 9)))

    @property
    def sparse(self) -> int:
        """The largest penalty within one standard error of the best."""
        k = self.smallest
        return int(np.flatnonzero(self.auc >= self.auc[k] - self.error[k])[0])

    def model(self, at: int | None = None) -> LinearScore:
        k = self.smallest if at is None else at
        return LinearScore(float(self.intercepts[k]), self.coefficients[k], float(self.penalties[k]))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(float(p), float(a), float(e), i == self.smallest, i == self.sparse)
                for i, (p, a, e) in enumerate(zip(self.penalties, self.auc, self.error))]
        return spark.createDataFrame(rows, "lambda double, auc double, se double, is_min boolean, is_1se boolean")


def inner_fold(number: np.ndarray, folds: int) -> np.ndarray:
    """A fold from the row's number, by other bits than the ones bags use first."""
    return (number // 8) % folds


def _seen(part: tuple, held: int, inner: int, folds: int) -> np.ndarray:
    _, _, w, number, fold = part
    return w * (fold != held) * ((inner_fold(number, folds) != inner) if inner >= 0 else 1)


def _steps(part: tuple, problems: list, beta: np.ndarray, centre: np.ndarray, scale: np.ndarray, folds: int) -> np.ndarray:
    """Per problem and penalty: weighted second moments and products with the working residual."""
    x, y = part[0], part[1]
    d = x.shape[1] + 1
    i, j = np.triu_indices(d)  # the moments are symmetric
    half = np.zeros((*beta.shape[:2], len(i)))
    out = np.zeros((*beta.shape[:2], d * d + d))
    for at in range(0, len(y), CHUNK):
        rows = tuple(v[at:at + CHUNK] for v in part)
        for k, (held, inner, _) in enumerate(problems):
            w = _seen(rows, held, inner, folds)
            z = np.column_stack([np.ones(len(w)), (rows[0] - centre[k]) / scale[k]])[w > 0]
            w, t = w[w > 0], rows[1][w > 0]
            eta = z @ beta[k].T
            p = np.negative(eta)
            np.exp(p, out=p)
            p += 1
            np.divide(1, p, out=p)
            np.clip(p, 1e-5, 1 - 1e-5, out=p)
            v = 1 - p
            v *= p
            r = np.multiply(v, eta, out=eta)
            r += t[:, None]
            r -= p
            if (w != 1).any():
                v *= w[:, None]
                r *= w[:, None]
            half[k] += v.T @ (z[:, i] * z[:, j])
            out[k, :, d * d:] += r.T @ z
    full = out[..., :d * d].reshape(*beta.shape[:2], d, d)
    full[..., i, j] = full[..., j, i] = half
    out[..., :d * d] = full.reshape(*beta.shape[:2], -1)
    return out


def descend(moments: np.ndarray, products: np.ndarray, beta: np.ndarray, l1: np.ndarray, l2: np.ndarray,
            rounds: int = 8, sweeps: int = 4, tolerance: float = 1e-7) -> np.ndarray:
    """Coordinate descent on many quadratic problems at once; the first coordinate has no penalty.

    Minimises b A b / 2 - c b + l1 |b| + l2 b b / 2 for each of the problems in the leading dimensions. After some sweeps the
    coordinates that are not 0 are solved together; the solution is taken where it keeps their signs.
    """
    beta = beta.copy()
    d = beta.shape[-1]
    free = np.arange(d) == 0
    ridge = np.where(free, 0.0, l2[..., None])
    diagonal = np.einsum("...jj->...j", moments)
    for _ in range(rounds):
        before = beta.copy()
        rest = products - (moments @ beta[..., None])[..., 0]
        for _ in range(sweeps):
            for j in range(d):
                old = beta[..., j].copy()
                rho = rest[..., j] + diagonal[..., j] * old
                if j:
                    rho = np.sign(rho) * np.maximum(np.abs(rho) - l1, 0)
                new = np.divide(rho, diagonal[..., j] + ridge[..., j], out=np.zeros_like(rho), where=diagonal[..., j] > 1e-12)
                rest -= moments[..., j, :] * (new - old)[..., None]
                beta[..., j] = new
        on = (beta != 0) | free
        system = moments * on[..., None] * on[..., None, :]
        system[..., np.arange(d), np.arange(d)] += np.where(on, ridge + 1e-9, 1.0)
        goal = np.where(on, products - np.where(free, 0.0, l1[..., None] * np.sign(beta)), 0.0)
        solved = np.linalg.solve(system, goal[..., None])[..., 0]
        fits = (np.isfinite(solved) & ((np.sign(solved) == np.sign(beta)) | free)).all(axis=-1)
        beta = np.where(fits[..., None], solved, beta)
        if np.abs(beta - before).max() < tolerance:
            break
    return beta


def _areas(part: tuple, problems: list, beta: np.ndarray, centre: np.ndarray, scale: np.ndarray, folds: int) -> np.ndarray:
    """Rows that a fold leaves out, counted by label and score bin, for each problem and penalty."""
    out = np.zeros((*beta.shape[:2], 2, SCORE_BINS))
    for k, (held, inner, _) in enumerate(problems):
        if inner < 0:
            continue
        x, y, _, number, fold = part
        out_of = (fold != held) & (inner_fold(number, folds) == inner)
        p = 1 / (1 + np.exp(-(beta[k][:, :1].T + ((x[out_of] - centre[k]) / scale[k]) @ beta[k][:, 1:].T)))
        cell = np.minimum((p * SCORE_BINS).astype(int), SCORE_BINS - 1)
        for label in (0, 1):
            mine = cell[y[out_of] == label]
            index = (np.arange(beta.shape[1]) * SCORE_BINS + mine).ravel()
            out[k, :, label] += np.bincount(index, minlength=beta.shape[1] * SCORE_BINS).reshape(beta.shape[1], SCORE_BINS)
    return out


def area(counts: np.ndarray) -> np.ndarray:
    """Area under the curve from counts [..., label, bin]; rows of one bin count one half. No pairs: one half."""
    neg, pos = counts[..., 0, :], counts[..., 1, :]
    below = np.cumsum(neg, axis=-1) - neg
    pairs = pos.sum(axis=-1) * neg.sum(axis=-1)
    return np.divide((pos * (below + neg / 2)).sum(axis=-1), pairs, out=np.full(pairs.shape, 0.5), where=pairs > 0)


def penalty_paths(data: Binned, held: Sequence[int] = (-2,), folds: int = 5, alphas: Sequence[float] = (1.0,), n_penalties: int = 100,
                  ratio: float = 1e-4, steps: int = 30, tolerance: float = 1e-4) -> list[Path]:
    """A cross-validated path for every held-out fold and alpha (in that order), all in step.

    alpha 1 is the lasso, 0 the ridge (its path starts as for 0.001). The first penalty is the smallest
    that leaves every coefficient of the whole fit at 0; columns are scaled to unit deviation inside each fit.
    """
    problems = [(h, i, a) for h in held for a in alphas for i in range(-1, folds)]
    size = len(data.edges)
    n_parts = max(1, data.n_rows // part_size(data, 1 << 17))

    def pack(batches):
        for b in batches:
            x = np.stack(b.column(0).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, size))
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()]) for v in (
                x.astype(float), *(b.column(i).to_numpy().astype(t) for i, t in ((1, float), (2, float), (3, np.int64), (4, np.int64))))],
                ["x", "y", "w", "number", "fold"])

    def load(it):
        got = [(np.frombuffer(r.x).reshape(-1, size), np.frombuffer(r.y), np.frombuffer(r.w), np.frombuffer(r.number, np.int64),
                np.frombuffer(r.fold, np.int64)) for r in it]
        if got:
            yield tuple(np.concatenate(c) for c in zip(*got))

    # partitions as arrays: moments of many fits in one pass are matrix products
    rows = data.rows.select("x", "y", "w", "number", "fold").repartition(n_parts, "number").mapInArrow(
        pack, "x binary, y binary, w binary, number binary, fold binary").rdd.mapPartitions(load).persist(StorageLevel.MEMORY_AND_DISK)

    def first(part: tuple) -> np.ndarray:
        x, y = part[0], part[1]
        return np.stack([np.concatenate([[w.sum(), (w * y).sum()], w @ x, w @ (x * x), (w * y) @ x])
                         for w in (_seen(part, *p[:2], folds) for p in problems)])

    def total(of, n: int) -> np.ndarray:
        pairs = rows.flatMap(lambda part: ((k, of(part, k)) for k in range(n)))
        return np.stack([v for _, v in sorted(added(pairs, min(n, rows.context.defaultParallelism)).collect(), key=lambda kv: kv[0])])

    sums = rows.map(first).treeReduce(np.add)
    n, mean_y = np.maximum(sums[:, 0], 1e-12), sums[:, 1] / np.maximum(sums[:, 0], 1e-12)
    centre = sums[:, 2:2 + size] / n[:, None]
    spread = np.sqrt(np.maximum(sums[:, 2 + size:2 + 2 * size] / n[:, None] - centre ** 2, 0))
    scale = np.where(spread > 1e-9, spread, np.inf)  # a constant column has no coefficient
    cross = np.abs(sums[:, 2 + 2 * size:] / n[:, None] - centre * mean_y[:, None]) / scale
    whole = [k for k, p in enumerate(problems) if p[1] < 0]
    # with room for rounding, which follows the order of rows
    grids = {problems[k][0]: max(cross[k].max(), 1e-9) * (1 + 1e-10) * ratio ** np.linspace(0, 1, n_penalties) for k in whole}
    alpha = np.array([a for _, _, a in problems])[:, None]
    penalty = np.stack([grids[h] for h, _, _ in problems]) / np.maximum(alpha, 1e-3)

    beta = np.zeros((len(problems), n_penalties, size + 1))
    p0 = np.clip(mean_y, 1e-5, 1 - 1e-5)
    beta[:, :, 0] = np.log(p0 / (1 - p0))[:, None]
    active = list(range(len(problems)))
    for _ in range(steps):
        some, b, c, s = [problems[k] for k in active], beta[active], centre[active], scale[active]
        got = total(lambda part, k: _steps(part, some[k:k + 1], b[k:k + 1], c[k:k + 1], s[k:k + 1], folds)[0], len(some)) / n[active][:, None, None]
        d = size + 1
        l1, l2 = (penalty * alpha)[active], (penalty * (1 - alpha))[active]
        moments = got[..., :d * d].reshape(*got.shape[:2], d, d)
        new = descend(moments, got[..., d * d:], b, l1, l2)
        # how far scores moved, in the weights of the step: columns that add up to others may go on changing places
        moved = np.sqrt(np.maximum(np.einsum("klj,klj->kl", new - b, (moments @ (new - b)[..., None])[..., 0]), 0)).max(axis=1)
        beta[active] = new
        active = [k for k, m in zip(active, moved) if m > tolerance]
        if not active:
            break
    counts = total(lambda part, k: _areas(part, problems[k:k + 1], beta[k:k + 1], centre[k:k + 1], scale[k:k + 1], folds)[0], len(problems))
    rows.unpersist()
    out = []
    for k in whole:
        inner = [i for i, p in enumerate(problems) if (p[0], p[2]) == (problems[k][0], problems[k][2]) and p[1] >= 0]
        each, size_of = area(counts[inner]), counts[inner][:, 0].sum(axis=(1, 2))
        share = size_of / max(size_of.sum(), 1)
        mean = 0.5 + share @ (each - 0.5)  # exactly one half where no fold has pairs
        error = np.sqrt(share @ (each - mean) ** 2 / max(len(inner) - 1, 1))
        coefficients = beta[k, :, 1:] / scale[k]
        out.append(Path(penalty[k], mean, error, beta[k, :, 0] - coefficients @ centre[k], coefficients))
    return out
