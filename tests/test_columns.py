import math

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import aggregates as A
from propensity.operators import features as X
from propensity.operators import joins as J
from propensity.operators import reshape as R
from propensity.operators import subscribers as S


def test_lower_bound_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.2,), (3.0,)], "x double")
    assert [r.y for r in df.select(C.at_least(F.col("x"), 1.0).alias("y")).collect()] == [None, 1.0, 3.0]


def test_division_guards_differ_on_null(spark):
    df = spark.createDataFrame([(6.0, None), (6.0, 0.5), (6.0, 3.0)], "a double, b double")
    got = df.select(C.per_positive(F.col("a"), F.col("b")).alias("p"),
                    C.per_at_least_one(F.col("a"), F.col("b")).alias("q")).collect()
    assert [(r.p, r.q) for r in got] == [(6.0, None), (12.0, 6.0), (2.0, 2.0)]


def test_first_match_and_flags(spark):
    df = spark.createDataFrame([(0.8,), (0.5,), (0.1,), (None,)], "p double")
    seg = C.first_match([(F.col("p") >= 0.7, "High"), (F.col("p") >= 0.4, "Medium")], "Low")
    assert [r.s for r in df.select(seg.alias("s")).collect()] == ["High", "Medium", "Low", "Low"]
    assert [r.f for r in df.select(C.flag(F.col("p") > 0.4).alias("f")).collect()] == [1, 1, 0, None]


def test_ids_round_trip(spark):
    df = spark.createDataFrame([(7,), (123456,)], "k bigint").withColumn("m", C.member_id(F.col("k")))
    assert [(r.m, r.n) for r in df.select("m", C.member_number(F.col("m")).alias("n")).collect()] == [
        ("SUB00007", 7), ("SUB123456", 123456)]


def test_rounding(spark):
    df = spark.createDataFrame([(2.5,), (0.125,)], "x double")
    got = df.select(C.half_up(F.col("x"), 0).alias("u"), C.half_even(F.col("x"), 2).alias("e")).collect()
    assert [r.u for r in got] == [3.0, 0.0] and got[1].e == 0.12


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.11,), (1.0,)], "p double")
    assert [r.b for r in df.select(A.right_closed_bin(F.col("p")).alias("b")).collect()] == [1, 1, 2, 10]


def test_class_means_use_complete_rows(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (1, 4.0, None), (0, 6.0, 3.0)], "y int, a double, b double")
    got = {r.y: (r.a, r.b) for r in A.class_means(df, "y").collect()}
    assert got == {1: (2.0, 1.0), 0: (6.0, 3.0)}


def test_contingency_keeps_empty_cells(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "a int, p int")
    assert {tuple(r) for r in A.contingency(df, "a", "p", [0, 1]).collect()} == {(0, 1, 0), (1, 1, 0)}


def test_impute_uses_training_median_for_null_and_nan(spark):
    train = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "x double")
    new = spark.createDataFrame([(None,), (float("nan"),), (5.0,)], "x double")
    assert [r.x for r in X.impute(new, X.medians(train, ["x"]), ["x"]).collect()] == [2.0, 2.0, 5.0]


def test_unseen_levels(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    new = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, c string")
    got = {r.id: r.c for r in X.align_levels(new, X.level_table(train, "c"), "c").collect()}
    assert got == {1: "a", 2: None, 3: None}
    assert [(r.c_a, r.c_b) for r in X.dummies(new, train, ["c"]).orderBy("id").collect()] == [
        (1, 0), (0, 0), (0, 0)]


def test_correlated_and_constant_columns(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"),
                                 F.sin("id").alias("c"), F.lit(1.0).alias("k"))
    dropped = X.correlated_columns(df, ["a", "b", "c"])
    assert len(dropped) == 1 and dropped[0] in ("a", "b")
    nzv = {r.feature: r["drop"] for r in X.near_zero_variance(df, ["a", "k"]).collect()}
    assert nzv == {"a": False, "k": True}


def test_align_columns_and_long(spark):
    df = spark.createDataFrame([(1, 2)], "b int, extra int")
    assert R.align_columns(df, ["a", "b"]).first().asDict() == {"a": 0, "b": 1}
    assert R.to_long(df, [], ["b", "extra"]).count() == 2


def test_join_helpers(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, x int")
    b = spark.createDataFrame([(2, 0.5)], "k int, p double")
    assert {tuple(r) for r in J.join_back(a, b, "k").collect()} == {(1, 10, None), (2, 20, 0.5)}
    assert J.full_outer([a, b, b.withColumnRenamed("p", "q")], "k").count() == 2
    assert J.repeated_keys(a.union(a), "k").count() == 2
    assert J.parameter_grid(b, {"m": [1, 2], "n": [3, 4, 5]}).count() == 6


def test_action_priority_order(spark):
    rows = [(1, "High", "Gold"), (0, "High", "Gold"), (0, "High", "Bronze"), (0, "Medium", "Platinum"),
            (None, "Low", "Gold")]
    df = spark.createDataFrame(rows, "s int, r string, t string")
    got = [r.a for r in df.select(S.action_priority(F.col("s"), F.col("r"), F.col("t")).alias("a")).collect()]
    assert got == ["Investigate fraud", "VIP save — immediate", "High-priority save",
                   "Proactive engagement", "Standard monitoring"]


def test_hash_fraction_is_uniform(spark):
    r = spark.range(20000).select(C.hash_fraction("id", 1).alias("u")).agg(
        F.avg("u").alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi")).first()
    assert math.isclose(r.m, 0.5, abs_tol=0.01) and 0 <= r.lo and r.hi < 1


def test_profile_of_nulls_and_one_value(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (None, None)], "a double, b double")
    got = {r.column: r for r in A.profile(df, ["a", "b"]).collect()}
    assert (got["a"].n, got["a"].mean, got["a"].median, got["a"].max) == (2, 2.0, 2.0, 3.0)
    assert (got["b"].n, got["b"].mean) == (0, None)
