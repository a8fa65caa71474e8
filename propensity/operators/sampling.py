"""Splits, folds and samples that depend on the key only, so a rerun repeats them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators.ordered import first_by_hash, hash_ranks


def with_split(df: DataFrame, key: str, shares: dict[str, float], seed: int = 42,
               name: str = "split") -> DataFrame:
    """Label each row with a part drawn by the shares. No shuffle."""
    u = C.hash_fraction(key, seed)
    total, edge, label = sum(shares.values()), 0.0, None
    parts = list(shares.items())
    for part, share in parts[:-1]:
        edge += share / total
        cond = u < F.lit(edge)
        label = F.when(cond, part) if label is None else label.when(cond, part)
    last = F.lit(parts[-1][0])
    return df.withColumn(name, last if label is None else label.otherwise(last))


def random_split(df: DataFrame, key: str, shares: Sequence[float], seed: int = 42) -> list[DataFrame]:
    names = [str(i) for i in range(len(shares))]
    marked = with_split(df, key, dict(zip(names, shares)), seed, "__part")
    return [marked.filter(F.col("__part") == n).drop("__part") for n in names]


def stratified_split(df: DataFrame, key: str, label: str, share: float, seed: int = 42) -> DataFrame:
    """Add `is_train`: exactly ceil(share * n) rows of each class."""
    return first_by_hash(df, key, F.ceil(F.lit(share) * F.col("n_group")), seed, [label], "is_train")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; class counts differ by at most one between folds."""
    ranked = hash_ranks(df, key, seed, [label])
    return ranked.withColumn(name, ((F.col("rank") - 1) % k).cast("int")).drop("rank", "n_group")


def poisson_edges(rate: float) -> list[float]:
    """Distribution function of the Poisson law at 0, 1, ..., as far as a fraction of 32 bits can tell."""
    term = total = math.exp(-rate)
    out, k = [total], 0
    while k < rate or term > 2.0 ** -34:
        k += 1
        term *= rate / k
        total += term
        out.append(total)
    return out


def fraction_sample(df: DataFrame, key: str, fraction: float, replacement: bool = False,
                    seed: int = 42) -> DataFrame:
    """A share of the rows, drawn by the key's hash: no shuffle, the same rows after a retry or in another file layout.

    Without replacement a row is in or out; with it a row comes as often as a Poisson law of mean `fraction` says, at
    most some hundred times the mean. Rows with one key share their draw; a null key is never drawn.
    """
    u = C.hash_fraction(key, seed)
    if not replacement:
        return df.filter(u < F.lit(fraction))
    times = F.size(F.filter(F.array(*[F.lit(e) for e in poisson_edges(fraction)]), lambda e: e <= F.col("__u")))
    drawn = df.withColumn("__u", u).filter("__u is not null").withColumn("__n", times)
    return drawn.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__n").cast("int")))).drop("__u", "__n", "__copy")


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows (all when there are fewer), those with the smallest key hash.

    A first pass counts rows per hash range and finds the range where n is reached, so
    that only rows up to it compete for the sample.
    """
    chosen = first_by_hash(df, key, F.lit(n), seed, name="__chosen", hex_digits=4)
    return chosen.filter("__chosen").drop("__chosen")


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    return df.orderBy(C.key_hash(key, seed), key)
