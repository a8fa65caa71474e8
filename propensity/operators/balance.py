"""Class balance: weights and resampling. All draws depend on keys, so reruns repeat them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators.neighbours import distinct_points, nearest
from propensity.operators.ordered import hash_ranks


def class_sizes(df: DataFrame, label: str) -> Column:
    """Struct (n, n0, n1) of the whole frame as a scalar subquery."""
    y = F.col(label)
    return df.agg(F.struct(F.count("*").alias("n"), F.count_if(y == 0).alias("n0"),
                           F.count_if(y == 1).alias("n1"))).scalar()


def add_class_weight(df: DataFrame, label: str, name: str = "class_weight") -> DataFrame:
    """n / (2 n_class): both classes get the same total weight."""
    size = df.withColumn("__size", class_sizes(df, label))
    own = F.when(F.col(label) == 1, F.col("__size.n1")).otherwise(F.col("__size.n0"))
    return size.withColumn(name, F.col("__size.n") / (2 * own)).drop("__size")


def add_positive_weight(df: DataFrame, label: str, name: str = "pos_weight") -> DataFrame:
    """Negatives per positive for the positive class, 1 for the other."""
    size = df.withColumn("__size", class_sizes(df, label))
    ratio = F.try_divide(F.col("__size.n0"), F.col("__size.n1"))
    return size.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(1.0)).drop("__size")


def resize(df: DataFrame, key: str, label: str, target: Column, seed: int = 42) -> DataFrame:
    """Exactly `target` rows of each class (target may use label, n_group and outer columns).

    Every row is copied floor(target / n) times; the remainder goes to the first rows by
    key hash. Adds `copy` (1, 2, ...), so (key, copy) stays unique.
    """
    ranked = hash_ranks(df, key, seed, [label]).withColumn("__target", target)
    whole = F.floor(F.col("__target") / F.col("n_group"))
    extra = F.when(F.col("rank") <= F.col("__target") % F.col("n_group"), 1).otherwise(0)
    times = (whole + extra).cast("int")
    return (ranked.withColumn("__times", times).filter(F.col("__times") > 0)
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
            .drop("rank", "n_group", "__target", "__times"))


def oversample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """The smaller class grown to the size of the larger one."""
    sized = df.withColumn("__size", class_sizes(df, label))
    goal = F.greatest(F.col("__size.n0"), F.col("__size.n1"))
    return resize(sized, key, label, goal, seed).drop("__size")


def undersample(df: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    sized = df.withColumn("__size", class_sizes(df, label))
    goal = F.least(F.col("__size.n0"), F.col("__size.n1"))
    return resize(sized, key, label, goal, seed).drop("__size")


def normal_draw(key: Column, seed: int) -> Column:
    """Standard normal value of a key from two uniform hashes."""
    u = 1 - C.hash_fraction(key, seed)
    v = C.hash_fraction(key, seed + 1)
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * F.pi() * v)


def smoothed_bootstrap(df: DataFrame, key: str, label: str, cols: Sequence[str],
                       seed: int = 42) -> DataFrame:
    """As many rows as the input, classes drawn evenly, kernel noise on each column.

    Row i of the output draws a class and a position in it; the rows are found by a join
    on (class, position), which is unique.
    """
    base = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in cols])
    ranked = hash_ranks(base, key, seed, [label])
    spread = base.groupBy(label).agg(F.count("*").alias("__n"),
                                     *[F.stddev_samp(c).alias(f"__sd_{c}") for c in cols])
    sized = base.select(F.col(key).alias("__i")).withColumn("__size", class_sizes(base, label))
    ones = C.hash_fraction("__i", seed + 10) < 0.5
    n_class = F.when(ones, F.col("__size.n1")).otherwise(F.col("__size.n0"))
    draws = sized.select(
        "__i", ones.cast("int").alias("__label"),
        (F.floor(C.hash_fraction("__i", seed + 11) * n_class) + 1).alias("__rank"))
    hit = draws.join(ranked, (F.col("__label") == F.col(label)) & (F.col("__rank") == F.col("rank")))
    d = len(cols)
    h = F.pow(4.0 / ((d + 2) * F.col("__n")), 1.0 / (d + 4))
    noisy = [(F.col(c) + h * F.coalesce(F.col(f"__sd_{c}"), F.lit(0.0))
              * normal_draw(F.col("__i"), seed + 20 + 2 * j)).alias(c) for j, c in enumerate(cols)]
    return hit.join(spread, label).select(F.col("__i").alias("draw"), label, *noisy)


def interpolate_minority(df: DataFrame, key: str, label: str, cols: Sequence[str], k: int = 5,
                         perc_over: int = 200, perc_under: int = 150, seed: int = 42) -> DataFrame:
    """Minority rows, perc_over/100 synthetic rows each, and perc_under/100 majority rows
    per synthetic row. A synthetic row lies between a minority row and one of its k
    nearest minority rows (distance on columns scaled by their range)."""
    rows = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    minority = rows.filter(F.col(label) == 1)
    span = minority.agg(F.struct(*[
        F.greatest(F.max(c) - F.min(c), F.lit(1e-12)).alias(c) for c in cols])).scalar()
    scaled = minority.withColumn("__span", span).withColumn(
        "__v", F.array(*[F.col(c) / F.col(f"__span.{c}") for c in cols]))
    found = nearest(distinct_points(scaled, key, "__v"), k)
    # positions 1..k over rows: first the other copies of the same point, then its neighbours
    points = distinct_points(scaled, key, "__v").join(found, "pid")
    self_part = F.array(F.struct(F.lit(0.0).alias("distance"), F.col("pid"),
                                 (F.col("copies") - 1).alias("copies"), F.col("v")))
    points = points.select("v", F.concat(self_part, F.col("neighbours")).alias("around"))
    extra = perc_over // 100
    made = (scaled.join(points, F.col("__v") == F.col("v"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(extra))))
            .withColumn("__key", F.concat_ws(":", F.col(key), F.col("copy"))))
    total = F.aggregate("around", F.lit(0).cast("bigint"), lambda s, x: s + x["copies"])
    spot = F.floor(C.hash_fraction("__key", seed) * F.least(F.lit(k), total)) + 1
    state = F.struct(F.lit(0).cast("bigint").alias("seen"), F.col("v").alias("v"))
    walk = F.aggregate("around", state, lambda s, x: F.struct(
        (s["seen"] + x["copies"]).alias("seen"),
        F.when((s["seen"] < F.col("__spot")) & (s["seen"] + x["copies"] >= F.col("__spot")), x["v"])
        .otherwise(s["v"]).alias("v")))
    u = C.hash_fraction("__key", seed + 1)
    made = (made.withColumn("__spot", spot).withColumn("__other", walk["v"]).withColumn("__u", u)
            .select(key, label, *[
                (F.col(c) + F.col("__u") * (F.col("__other")[i] * F.col(f"__span.{c}") - F.col(c)))
                .alias(c) for i, c in enumerate(cols)], "copy",
                F.lit("synthetic").alias("origin")))
    majority = rows.filter(F.col(label) == 0).withColumn("__size", class_sizes(rows, label))
    goal = F.floor(F.col("__size.n1") * extra * perc_under / 100)
    kept = resize(majority, key, label, goal, seed).drop("__size").withColumn(
        "origin", F.lit("majority"))
    own = minority.withColumns({"copy": F.lit(0), "origin": F.lit("minority")})
    return reduce(DataFrame.unionByName, [own, made, kept])
