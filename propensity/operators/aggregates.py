"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators.ordered import quantile_of_runs, value_runs


def group_summary(df: DataFrame, key: str, means: dict[str, str] | None = None,
                  digits: dict[str, int] | None = None) -> DataFrame:
    """Rows per key with means (new name -> column), rounded where asked."""
    digits = digits or {}
    out = []
    for name, col in (means or {}).items():
        mean = F.avg(F.nanvl(F.col(col).cast("double"), F.lit(None)))
        out.append((C.half_up(mean, digits[name]) if name in digits else mean).alias(name))
    return df.groupBy(key).agg(F.count("*").alias("n"), *out)


def share_of_total(counts: DataFrame, n: str = "n") -> DataFrame:
    """Percent of the total, for a frame that already has one row per class."""
    return counts.withColumn("pct", F.col(n) * 100.0 / F.sum(n).over(Window.partitionBy()))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return share_of_total(df.groupBy(label).agg(F.count("*").alias("n")))


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def class_means(df: DataFrame, label: str) -> DataFrame:
    """Mean of every numeric column per class over complete rows."""
    cols = [c for c in C.numeric_columns(df) if c != label]
    return (df.select(label, *cols).dropna()
            .groupBy(label).agg(*[F.avg(c).alias(c) for c in cols]))


def contingency(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Two-way counts; fixed values keep the empty cells."""
    return df.groupBy(rows).agg(*[
        F.count_if(F.col(columns) == F.lit(v)).alias(f"n_{v}") for v in values])


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: count, min, quartiles, mean, max. One pass over the rows."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value")
    v, n = F.col("v"), F.col("n")
    out = value_runs(long, "value", ["column"]).groupBy("column").agg(
        F.sum(n).alias("n"), F.min(v).alias("min"), (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.max(v).alias("max"), quantile_of_runs(0.25).alias("q1"),
        quantile_of_runs(0.5).alias("median"), quantile_of_runs(0.75).alias("q3"))
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return named.join(out, "column", "left").fillna(0, ["n"])  # a column of nulls keeps its row


def pair_statistics(df: DataFrame, cols: Sequence[str], fn: str = "corr") -> DataFrame:
    """A symmetric statistic for every column pair (a <= b by position), one pass."""
    stat = {"corr": F.corr, "covar": F.covar_samp}[fn]
    pairs = list(combinations_with_replacement(cols, 2))
    one = df.agg(*[stat(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"s{i}")
                   for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                              F.col(f"s{i}").alias("value")) for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(rows))


def full_matrix(pairs: DataFrame) -> DataFrame:
    """Both halves of a symmetric pair table."""
    mirror = pairs.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "value")
    return pairs.unionByName(mirror)


def column_spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each column as rows."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value")
    return long.groupBy("feature").agg(F.avg("value").alias("mean"),
                                       F.stddev_samp("value").alias("sd"))


def right_closed_bin(p: Column, bins: int = 10) -> Column:
    """Bin number 1..bins of p in [0, 1]; intervals (a, b], the first takes 0 too."""
    return F.greatest(F.ceil(p * bins), F.lit(1)).cast("int")


def bin_means(df: DataFrame, p: str, y: str, bins: int = 10) -> DataFrame:
    return (df.groupBy(right_closed_bin(F.col(p), bins).alias("bin"))
            .agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"),
                 F.avg(F.col(y).cast("double")).alias("mean_y")))


def histogram(df: DataFrame, value: str, lo: float, hi: float, bins: int,
              by: Sequence[str] = ()) -> DataFrame:
    """Counts and density per equal-width bin (0-based; the top edge is in the last bin)."""
    width = (hi - lo) / bins
    spot = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    counts = (df.filter((F.col(value) >= lo) & (F.col(value) <= hi))
              .groupBy(*by, spot.cast("int").alias("bin")).agg(F.count("*").alias("n")))
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("density", F.col("n") / total / F.lit(width))
