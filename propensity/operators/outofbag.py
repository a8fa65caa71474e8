"""What trees of a forest say about rows outside their bags.

Bag weights are hashes of row and tree, so a scan of the binned rows knows them again: nothing is stored at the fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.operators.boosting import PRIME, Binned, Spec, TreeModel, bag, poisson_cuts, rows_of
from propensity.operators.ordered import hash_ranks
from propensity.session import keep


def _outside(model: TreeModel, number: np.ndarray) -> np.ndarray:
    """trees x rows: whether the tree did not see the row."""
    return np.stack([bag(number, model.spec, t) == 0 for t in range(len(model.trees))])


def bag_counts(data: Binned, spec: Spec) -> DataFrame:
    """(key, n_out, n_seen): trees that do not see a row, and how often the others see it in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            weights = np.stack([bag(b.column(1).to_numpy(), spec, t) for t in range(spec.rounds)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((weights == 0).sum(axis=0)), pa.array(weights.sum(axis=0).astype(np.int64))],
                                             ["key", "n_out", "n_seen"])

    rows = data.rows.select("key", "number")
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, n_out bigint, n_seen bigint").withColumnRenamed("key", data.key)


def bag_counts_sql(rows: str, key: str, spec: Spec) -> str:
    """The same in DuckDB SQL over a relation with the key."""
    a = f"(1 + (48271 * (t + 1) + 69621 * {spec.seed}) % {PRIME - 1})"
    b = f"((16807 * (t + 1) + {spec.seed}) % {PRIME})"
    weight = " + ".join(f"CAST(u >= {c!r}::DOUBLE AS BIGINT)" for c in poisson_cuts(spec.row_share).tolist())
    return f"""SELECT "{key}", count(*) FILTER (w = 0) AS n_out, CAST(sum(w) AS BIGINT) AS n_seen FROM (
SELECT "{key}", {weight} AS w FROM (SELECT "{key}", ((r * {a} + {b}) % {PRIME}) / CAST({PRIME} AS DOUBLE) AS u FROM (
SELECT "{key}", CAST('0x' || md5(CAST("{key}" AS VARCHAR))[1:8] AS BIGINT) % {PRIME} AS r FROM {rows}), range({spec.rounds}) AS trees(t))) GROUP BY 1"""


def votes(data: Binned, model: TreeModel) -> DataFrame:
    """(key, label, n_trees, vote_share): votes for class 1 of the trees that did not see the row; null without any."""
    n_features = len(data.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = rows_of(b, n_features)
            out = _outside(model, r.number)
            n, yes = out.sum(axis=0), ((model.leaf_values(r.bins) >= 0.5) & out).sum(axis=0)
            share = np.divide(yes, n, out=np.zeros(len(n)), where=n > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(r.y.astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(share, mask=n == 0)],
                                             ["key", "label", "n_trees", "vote_share"])

    rows = data.rows.select("key", "bins", "y", "w", "number", "fold")
    return rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, label int, n_trees bigint, vote_share double").withColumnRenamed("key", data.key)


def error_by_trees(data: Binned, model: TreeModel) -> DataFrame:
    """(trees, error, error_0, error_1, is_best): out-of-bag error of the first 1..T trees, overall and per class.

    Rows that no tree has left out yet are not judged. Counts are summed per batch before they are shuffled.
    """
    n_features = len(data.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = rows_of(b, n_features)
            out = _outside(model, r.number)
            n = np.cumsum(out, axis=0)
            wrong = (2 * np.cumsum((model.leaf_values(r.bins) >= 0.5) & out, axis=0) >= n) != (r.y == 1)
            cells = [((n > 0) & (r.y == y) & m).sum(axis=1) for y in (0, 1) for m in (True, wrong)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, len(n) + 1, dtype=np.int32)), *map(pa.array, cells)],
                                             ["trees", "n0", "wrong0", "n1", "wrong1"])

    rows = data.rows.select("bins", "y", "w", "number", "fold")
    sums = rows.mapInArrow(run, "trees int, n0 bigint, wrong0 bigint, n1 bigint, wrong1 bigint").groupBy("trees").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("n0", "wrong0", "n1", "wrong1")])
    curve = sums.select("trees", F.try_divide(F.col("wrong0") + F.col("wrong1"), F.col("n0") + F.col("n1")).alias("error"),
                        F.try_divide("wrong0", "n0").alias("error_0"), F.try_divide("wrong1", "n1").alias("error_1"))
    best = F.row_number().over(Window.partitionBy().orderBy(F.asc_nulls_last("error"), "trees")) == 1  # a row per tree
    return curve.withColumn("is_best", best)


def grid_errors(data: Binned, models: Sequence[TreeModel], sizes: Sequence[int]) -> DataFrame:
    """(model, trees, error, brier): out-of-bag error and Brier score of the first trees of every forest."""
    n_features = len(data.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = rows_of(b, n_features)
            got = []
            for k, m in enumerate(models):
                out, values = _outside(m, r.number), m.leaf_values(r.bins)
                for size in sizes:
                    o = out[:size]
                    n = o.sum(axis=0)
                    p = (values[:size] * o).sum(axis=0)[n > 0] / n[n > 0]
                    y = r.y[n > 0]
                    got.append((k, size, len(y), float(((p >= 0.5) != (y == 1)).sum()), float(((p - y) ** 2).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got)], ["model", "trees", "n", "wrong", "squares"])

    rows = data.rows.select("bins", "y", "w", "number", "fold")
    sums = rows.mapInArrow(run, "model bigint, trees bigint, n bigint, wrong double, squares double").groupBy("model", "trees").agg(
        *[F.sum(c).alias(c) for c in ("n", "wrong", "squares")])
    return sums.select(F.col("model").cast("int").alias("model"), F.col("trees").cast("int").alias("trees"),
                       F.try_divide("wrong", "n").alias("error"), F.try_divide("squares", "n").alias("brier"))


def permutation_importance(data: Binned, model: TreeModel, names: Sequence[str], seed: int = 42) -> DataFrame:
    """(feature, importance, sd, scaled): mean over the trees of the drop in out-of-bag accuracy when a feature takes another row's value.

    Partners are the next rows in the order of a key hash, a permutation of all rows. sd is that of the trees' drops, and
    scaled the mean over its standard error.
    """
    n_features = len(data.edges)
    ranked = keep(hash_ranks(data.rows.select("key", "bins", "y", "w", "number", "fold"), "key", seed))
    others = ranked.select((F.col("rank") % F.col("n_group") + 1).alias("turn"), F.col("bins").alias("other"))
    pairs = ranked.join(others, F.col("rank") == F.col("turn")).select("bins", "y", "w", "number", "fold", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = rows_of(b, n_features)
            other = np.frombuffer(b"".join(b.column(5).to_pylist()), np.uint8).reshape(-1, n_features)
            out = _outside(model, r.number)
            right = ((model.leaf_values(r.bins) >= 0.5) == (r.y == 1)) & out
            for f in range(n_features):
                mixed = r.bins.copy()
                mixed[:, f] = other[:, f]
                lost = right.sum(axis=1) - (((model.leaf_values(mixed) >= 0.5) == (r.y == 1)) & out).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), pa.array(np.full(len(out), f)), pa.array(lost.astype(np.int64)),
                                                  pa.array(out.sum(axis=1).astype(np.int64))], ["tree", "f", "lost", "n"])

    sums = pairs.mapInArrow(run, "tree bigint, f bigint, lost bigint, n bigint").groupBy("tree", "f").agg(F.sum("lost").alias("lost"), F.sum("n").alias("n"))
    drops = sums.select("f", F.coalesce(F.try_divide(F.col("lost").cast("double"), "n"), F.lit(0.0)).alias("drop"))
    named = F.array(*map(F.lit, names))
    out = drops.groupBy("f").agg(F.avg("drop").alias("importance"), F.stddev_samp("drop").alias("sd"), F.count("*").alias("n"))
    return out.select(F.get(named, F.col("f").cast("int")).alias("feature"), "importance", "sd",
                      F.try_divide(F.col("importance"), F.col("sd") / F.sqrt("n")).alias("scaled"))
