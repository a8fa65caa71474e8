"""Ranks, running totals and quantiles over a whole table without a one-task sort.

Rows are spread over ranges of the order column. The totals of the ranges (a few
hundred rows) give each range its starting value; inside a range an ordinary window
does the rest. A group that holds most rows is therefore split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.session import keep

RANGE = "__range"


def range_edges(df: DataFrame, column: str, ranges: int | None = None) -> list[float]:
    """Cut points that put about the same number of rows into each range."""
    spark = df.sparkSession
    # as many as tasks, and more for more rows: a range stays at about a million rows
    n = ranges or max(16, int(spark.conf.get("spark.sql.shuffle.partitions", "200")), df.count() // 1_000_000)
    probs = [i / n for i in range(1, n)]
    cuts = df.select(F.col(column).cast("double").alias(column)).approxQuantile(
        column, probs, 0.5 / n)
    return sorted(set(cuts))


def with_range(df: DataFrame, column: str, ranges: int | None = None) -> DataFrame:
    edges = range_edges(df, column, ranges)
    if not edges:
        return df.withColumn(RANGE, F.lit(0.0))
    splits = [-float("inf"), *edges, float("inf")]
    source = f"{RANGE}_in"
    cut = Bucketizer(splits=splits, inputCol=source, outputCol=RANGE)
    return cut.transform(df.withColumn(source, F.col(column).cast("double"))).drop(source)


def running_totals(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = (),
                   descending: bool = False, ranges: int | None = None) -> DataFrame:
    """Add cum_<v> (up to and with this row) and all_<v> (whole group) for each value.

    `order` must be unique within `by`: aggregate equal order values first. Rows with a
    null or NaN order value are left out, as no position is defined for them. The rows are
    written once, so finding the ranges does not compute the input a second time.
    """
    by = list(by)
    valid = keep(df.filter(F.col(order).isNotNull() & ~F.isnan(F.col(order).cast("double"))))
    cut = with_range(valid, order, ranges)
    side = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    per_range = cut.groupBy(*by, RANGE).agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*by).orderBy(side(RANGE)).rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    # written, so that the planner sees its size: small enough, it is broadcast and the
    # rows are shuffled once; if groups are many, it is an ordinary join
    starts = keep(per_range.select(
        *[F.col(b).alias(f"__{b}") for b in by], F.col(RANGE).alias("__r"),
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"__before_{v}") for v in values],
        *[F.sum(v).over(whole).alias(f"all_{v}") for v in values]))
    inside = Window.partitionBy(*by, RANGE).orderBy(side(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    cond = F.col(RANGE) == F.col("__r")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__{b}"))
    joined = cut.join(starts, cond)
    return joined.select(
        *df.columns,
        *[(F.col(f"__before_{v}") + F.sum(v).over(inside)).alias(f"cum_{v}") for v in values],
        *[F.col(f"all_{v}") for v in values])


def _hash_starts(df: DataFrame, key: str, seed: int, by: list[str], digits: int) -> DataFrame:
    """Rows, rows before, and group size of each hash range."""
    prefix = F.substring(C.key_hash(key, seed), 1, digits)
    per_range = df.groupBy(*by, prefix.alias("__r")).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    return keep(per_range.select(
        *[F.col(b).alias(f"__{b}") for b in by], "__r", "__n",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*by)).alias("n_group")))


def _join_starts(df: DataFrame, starts: DataFrame, key: str, seed: int, by: list[str],
                 digits: int) -> DataFrame:
    hashed = df.withColumn("__h", C.key_hash(key, seed)).withColumn(
        RANGE, F.substring("__h", 1, digits))
    cond = F.col(RANGE) == F.col("__r")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__{b}"))
    return hashed.join(starts, cond)


def hash_ranks(df: DataFrame, key: str, seed: int = 0, by: Sequence[str] = (),
               hex_digits: int = 3) -> DataFrame:
    """Add `rank` (1..n in the order of the key hash, within `by`) and `n_group`.

    The leading hex digits of the hash are the ranges: uniform whatever the keys are.
    """
    by = list(by)
    joined = _join_starts(df, _hash_starts(df, key, seed, by, hex_digits), key, seed, by, hex_digits)
    inside = Window.partitionBy(*by, RANGE).orderBy("__h", key)
    return joined.select(
        *df.columns, (F.col("__before") + F.row_number().over(inside)).alias("rank"), "n_group")


def first_by_hash(df: DataFrame, key: str, count: Column, seed: int = 0, by: Sequence[str] = (),
                  name: str = "chosen", hex_digits: int = 3) -> DataFrame:
    """Mark exactly the first `count` rows of each group in hash order.

    `count` may use n_group. Ranges wholly before or after the cut need no ranking; only
    the rows of the one range that holds the cut are shuffled and sorted.
    """
    by = list(by)
    starts = _hash_starts(df, key, seed, by, hex_digits)
    joined = _join_starts(df, starts, key, seed, by, hex_digits).withColumn("__cut", count)
    at_cut = (F.col("__before") < F.col("__cut")) & (F.col("__before") + F.col("__n") > F.col("__cut"))
    inside = Window.partitionBy(*by, RANGE).orderBy("__h", key)
    clear = joined.filter(~at_cut).select(
        *df.columns, (F.col("__before") + F.col("__n") <= F.col("__cut")).alias(name))
    edge = joined.filter(at_cut).select(
        *df.columns, (F.col("__before") + F.row_number().over(inside) <= F.col("__cut")).alias(name))
    return clear.unionByName(edge)


def value_runs(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and distinct value `v` with n, cum_n and all_n; no null, no NaN.

    Equal values are counted first, so a value that fills a third of the table is one row.
    """
    by = list(by)
    counts = (df.select(*by, F.col(column).cast("double").alias("v"))
              .filter(F.col("v").isNotNull() & ~F.isnan("v"))
              .groupBy(*by, "v").agg(F.count("*").alias("n")))
    return running_totals(counts, "v", ["n"], by)


def quantile_of_runs(p: float) -> Column:
    """Aggregate over value_runs rows: the p-quantile with linear interpolation."""
    pos = F.lit(float(p)) * (F.col("all_n") - 1)
    lo = F.min(F.when(F.col("cum_n") > F.floor(pos), F.col("v")))
    hi = F.min(F.when(F.col("cum_n") > F.ceil(pos), F.col("v")))
    return lo + (hi - lo) * F.max(pos - F.floor(pos))


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float],
                    by: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation, one row per group; null and NaN are left out."""
    return value_runs(df, column, by).groupBy(*by).agg(
        *[quantile_of_runs(p).alias(name) for name, p in probs.items()])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes first by `order` for each key; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """First n rows per key. Spark limits each group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def arg_best(df: DataFrame, metric: str, index: str, largest: bool = True) -> DataFrame:
    """The one row with the best metric; the lowest index wins a tie."""
    sign = F.col(metric) if largest else -F.col(metric)
    row = F.max_by(F.struct(*df.columns), F.struct(sign, -F.col(index)))
    return df.filter(F.col(metric).isNotNull()).agg(row.alias("__row")).select("__row.*")


def arg_extremes(df: DataFrame, metric: str, index: str) -> DataFrame:
    """The best and the worst row (`side` max and min) in one pass; lowest index on ties."""
    row = F.struct(*df.columns)
    hi = F.max_by(row, F.struct(F.col(metric), -F.col(index)))
    lo = F.min_by(row, F.struct(F.col(metric), F.col(index)))
    both = df.filter(F.col(metric).isNotNull()).agg(hi.alias("hi"), lo.alias("lo"))
    return both.select(F.inline(F.array(
        F.struct(F.lit("max").alias("side"), "hi.*"), F.struct(F.lit("min").alias("side"), "lo.*"))))
