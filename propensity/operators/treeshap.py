"""Exact Shapley values of tree models, path by path, row by row.

For a leaf only the features on its path matter. With z the share of training weight that goes on towards the leaf at the
splits of a feature, and o whether the row does, the value of a set of known features is the leaf's value times o of
the known and z of the others; the mean over all orders is a polynomial product over the path. Rows that agree in all o of
a leaf share one result: the results of a leaf are a table, filled once per task and looked up by row. The values of a row
sum to its score minus the mean score by training weight.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.operators.boosting import TreeModel

TABLE = 10  # features of a path whose patterns are all worked out ahead


def leaf_paths(tree: dict[str, np.ndarray]) -> list[tuple[float, dict[int, tuple[int, int, float]]]]:
    """Per leaf (value, feature -> (bin above which, bin up to which, share of weight))."""
    out = []
    stack: list[tuple[int, dict[int, tuple[int, int, float]]]] = [(0, {})]
    while stack:
        n, path = stack.pop()
        if tree["left"][n] < 0:
            out.append((float(tree["value"][n]), path))
            continue
        f, cut = int(tree["feature"][n]), int(tree["bin"][n])
        low, high, share = path.get(f, (-1, 1 << 30, 1.0))
        for child, a, b in ((int(tree["left"][n]), low, min(high, cut)), (int(tree["right"][n]), max(low, cut), high)):
            part = float(tree["cover"][child] / tree["cover"][n]) if tree["cover"][n] > 0 else 0.5
            stack.append((child, {**path, f: (a, b, share * part)}))
    return out


def path_shares(o: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Per pattern and path feature: (o - z) times the mean over orders of the product of the others. o: patterns x features."""
    m = len(z)
    weight = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.zeros(o.shape)
    for f in range(m):
        poly = np.zeros((len(o), m))
        poly[:, 0] = 1
        for j in range(m):
            if j != f:  # times (z + o x): the power counts known features
                poly[:, 1:] = poly[:, 1:] * z[j] + poly[:, :-1] * o[:, j:j + 1]
                poly[:, 0] *= z[j]
        out[:, f] = (o[:, f] - z[f]) * (poly @ weight)
    return out


@dataclass(frozen=True)
class Leaf:
    """A leaf's path: feature j goes on where its bin is above low[j] and up to high[j]; `table` holds the values per pattern of those."""
    features: list[int]
    low: list[int]
    high: list[int]
    share: np.ndarray
    value: float
    table: np.ndarray | None  # features x patterns; None: too many patterns

    def results(self, code: np.ndarray) -> np.ndarray:
        """Path features x rows; the bits of a row's code tell which features go on."""
        if self.table is not None:
            return self.table.take(code, axis=1)
        seen, place = np.unique(code, return_inverse=True)
        return pattern_values(seen, self.share, self.value)[:, place]


def pattern_values(patterns: np.ndarray, share: np.ndarray, value: float) -> np.ndarray:
    o = ((patterns[:, None] >> np.arange(len(share))) & 1).astype(float)
    return np.ascontiguousarray((value * path_shares(o, share)).T)


def leaves(model: TreeModel) -> list[Leaf]:
    out = []
    for tree in model.trees:
        for value, path in leaf_paths(tree):
            if path and value != 0:
                low, high, share = zip(*path.values())
                z = np.array(share)
                table = pattern_values(np.arange(1 << len(path)), z, value) if len(path) <= TABLE else None
                out.append(Leaf(list(path), list(low), list(high), z, value, table))
    return out


def shares(model: TreeModel, bins: np.ndarray, paths: Sequence[Leaf] | None = None) -> np.ndarray:
    """rows x features: Shapley values of the margin (boosted) or of the mean of trees (forest). `paths`: the model's leaves, if known."""
    out = np.zeros((len(model.edges), len(bins)))
    columns = [np.ascontiguousarray(bins[:, f]) for f in range(len(model.edges))]
    for leaf in leaves(model) if paths is None else paths:
        code = np.zeros(len(bins), np.int64)
        for k, (f, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high)):
            on = columns[f] <= high if low < 0 else columns[f] > low if high > 255 else (columns[f] > low) & (columns[f] <= high)
            code += on.astype(np.int64) << k
        for f, got in zip(leaf.features, leaf.results(code)):
            out[f] += got
    return out.T / len(model.trees) if model.spec.forest else out.T


def mean_score(model: TreeModel) -> float:
    """What the values of a row add to: the base and every leaf by its share of the training weight."""
    total = sum(v * float(np.prod([p[2] for p in path.values()])) for t in model.trees for v, path in leaf_paths(t))
    return total / len(model.trees) if model.spec.forest else model.base + total


def shapley_values(model: TreeModel, df: DataFrame, key: str, names: Sequence[str], features: str = "features") -> DataFrame:
    """(key, feature, value). The model is in the closure; rows are read once and not copied."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = None
        for b in batches:
            if b.num_rows:
                paths = leaves(model) if paths is None else paths
                got = shares(model, model.binned(np.stack(b.column(1).to_numpy(zero_copy_only=False))), paths)
                keys = b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), len(names))))
                yield pa.RecordBatch.from_arrays([keys, pa.array(list(names) * b.num_rows), pa.array(got.ravel())], ["key", "feature", "value"])

    x = df.select(F.col(key).alias("key"), vector_to_array(features).alias("x"))
    return x.mapInArrow(run, f"key {dict(x.dtypes)['key']}, feature string, value double").withColumnRenamed("key", key)
