"""Windows (W), sorts and top rows (O), set operations (D), samples and splits (X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V
from propensity.operators import aggregates as A
from propensity.operators import metrics as M
from propensity.operators import ordered, reshape, sampling, series
from propensity.plans import view_sql as Q
from propensity.plans.registry import query, rnd
from propensity.session import keep
from propensity.sources import tables, views

# ---- windows -------------------------------------------------------------------------


@query("w1_share_of_total", f"""SELECT event_type, count(*) AS n,
{rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 4)} AS pct FROM events GROUP BY 1""")
def w1(spark, d):
    out = A.class_balance(tables.table(spark, d, "events"), "event_type")
    return out.withColumn("pct", C.half_up(F.col("pct"), 4))


@query("w2_first_row_per_pair", """SELECT o_custkey, l_partkey, l_orderkey, l_linenumber, l_quantity FROM (
SELECT *, row_number() OVER (PARTITION BY o_custkey, l_partkey
  ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS rn
FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""")
def w2(spark, d):
    lines = tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    # first per (order, part) before the join, first per (user, part) after it
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]
    lines = ordered.keep_first(lines, ["l_orderkey", "l_partkey"], order[1:])
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return ordered.keep_first(rows, ["o_custkey", "l_partkey"], order).select(
        "o_custkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("w3_top_n_per_user", Q.with_views(Q.RATINGS) + f"""
SELECT user_id, item_id, rank, {rnd('rating', 4)} AS rating FROM (
SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS INTEGER) AS rank
FROM ratings) WHERE rank <= 5""")
def w3(spark, d):
    out = ordered.top_n(views.ratings(spark, d), ["user_id"], [F.desc("rating"), "item_id"], 5)
    return out.withColumn("rating", C.half_up(F.col("rating"), 4))


@query("w4_lags", Q.with_views(Q.WEEKLY) + """
SELECT series, week, y, lag(y, 1) OVER w AS y_lag1, lag(y, 2) OVER w AS y_lag2, lag(y, 52) OVER w AS y_lag52
FROM weekly WINDOW w AS (PARTITION BY series ORDER BY week)""")
def w4(spark, d):
    return series.add_lags(views.weekly_orders(spark, d), "series", "week", "y",
                           [1, 2, V.SEASON_WEEKS])


@query("w5_differences", Q.with_views(Q.WEEKLY) + """
SELECT series, week, y, y - lag(y, 1) OVER w AS diff1, y - 2 * lag(y, 1) OVER w + lag(y, 2) OVER w AS diff2
FROM weekly WINDOW w AS (PARTITION BY series ORDER BY week)""")
def w5(spark, d):
    df = series.difference(views.weekly_orders(spark, d), "series", "week", "y", 1, "diff1")
    return series.difference(df, "series", "week", "y", 2, "diff2")


# ---- sorts and top rows --------------------------------------------------------------

@query("o1_descending_sort", Q.with_views(Q.SCORES)
       + "SELECT subscriber_id, p_rf FROM scores ORDER BY p_rf DESC, subscriber_id")
def o1(spark, d):
    return views.scores(spark, d).select("subscriber_id", "p_rf").orderBy(
        F.desc("p_rf"), "subscriber_id")


@query("o2_top_k", Q.with_views(Q.SCORES)
       + "SELECT subscriber_id, p_xgb FROM scores ORDER BY p_xgb DESC, subscriber_id LIMIT 10")
def o2(spark, d):
    return views.scores(spark, d).select("subscriber_id", "p_xgb").orderBy(
        F.desc("p_xgb"), "subscriber_id").limit(10)


@query("o3_preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def o3(spark, d):
    return tables.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice").orderBy("o_orderkey").limit(10)


def sweep_sql(score: str, first: int, last: int, step: int, source: str = "scores") -> str:
    return f"""sweep AS (SELECT CAST(t AS INTEGER) AS pct,
 count(*) FILTER (label = 1 AND {score} >= t / 100.0::DOUBLE) AS tp,
 count(*) FILTER (label = 0 AND {score} >= t / 100.0::DOUBLE) AS fp,
 count(*) FILTER (label = 0 AND {score} < t / 100.0::DOUBLE) AS tn,
 count(*) FILTER (label = 1 AND {score} < t / 100.0::DOUBLE) AS fn
 FROM {source}, range({first}, {last + 1}, {step}) r(t) GROUP BY 1),
rated AS (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
 CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
 2.0 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM sweep)"""


@query("o4_arg_best", Q.with_views(Q.SCORES, sweep_sql("p_rf", *V.SWEEP_WIDE)) + f"""
SELECT 'max' AS side, pct, {rnd('f1', 6)} AS f1 FROM
 (SELECT * FROM rated WHERE f1 IS NOT NULL ORDER BY f1 DESC, pct LIMIT 1)
UNION ALL SELECT 'min', pct, {rnd('f1', 6)} FROM
 (SELECT * FROM rated WHERE f1 IS NOT NULL ORDER BY f1, pct LIMIT 1)""")
def o4(spark, d):
    sweep = M.threshold_sweep(views.scores(spark, d), "label", "p_rf", M.grid(*V.SWEEP_WIDE))
    return ordered.arg_extremes(sweep, "f1", "pct").select(
        "side", "pct", C.half_up(F.col("f1"), 6).alias("f1"))


# ---- set operations ------------------------------------------------------------------

@query("d1_append_rows", Q.with_views(Q.SCORES) + """
SELECT subscriber_id, label FROM scores WHERE label = 0
UNION ALL SELECT subscriber_id, label FROM scores WHERE label = 1
UNION ALL SELECT subscriber_id, label FROM scores WHERE label = 1""")
def d1(spark, d):
    s = views.scores(spark, d).select("subscriber_id", "label")
    minority = s.filter(F.col("label") == 1)
    return reshape.append_rows(reshape.append_rows(s.filter(F.col("label") == 0), minority), minority)


@query("d2_align_columns", """SELECT s_suppkey AS key, s_acctbal AS balance, 0 AS segment_code, s_nationkey AS nation
FROM supplier""")
def d2(spark, d):
    train = ["key", "balance", "segment_code", "nation"]
    new = tables.table(spark, d, "supplier").select(
        F.col("s_name").alias("extra"), F.col("s_nationkey").alias("nation"),
        F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return reshape.align_columns(new, train)


_U = "CAST('0x' || substr(md5({k} || '|{seed}'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


def u_sql(key: str, seed: int = 42) -> str:
    return _U.format(k=f"CAST({key} AS VARCHAR)", seed=seed)


@query("d3_row_complement", f"SELECT c_custkey, c_name FROM customer WHERE NOT ({u_sql('c_custkey')} < 0.8)")
def d3(spark, d):
    cust = tables.table(spark, d, "customer").select("c_custkey", "c_name")
    train, _ = sampling.random_split(cust, "c_custkey", [0.8, 0.2])
    return reshape.rows_not_in(cust, train, "c_custkey")


@query("d4_wide_to_long", Q.with_views(Q.LONG_SCORES)
       + "SELECT custkey, 'p_' || model AS metric, p AS value FROM long_scores")
def d4(spark, d):
    return reshape.to_long(views.scores(spark, d), ["custkey"], [f"p_{m}" for m in views.MODELS])


# ---- samples and splits --------------------------------------------------------------

@query("x1_random_split", f"""SELECT o_orderkey, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {u_sql('o_orderkey')} AS u FROM orders)""")
def x1(spark, d):
    return sampling.with_split(tables.table(spark, d, "orders").select("o_orderkey"), "o_orderkey",
                               {"train": 0.7, "val": 0.15, "test": 0.15})


@query("x2_train_test_split", f"""SELECT part, count(*) AS n, {rnd('sum(o_totalprice)', 2)} AS total FROM (
SELECT o_totalprice, CASE WHEN {u_sql('o_orderkey', 27)} < 0.7 THEN 'train' ELSE 'test' END AS part FROM orders)
GROUP BY 1""")
def x2(spark, d):
    parts = sampling.with_split(tables.table(spark, d, "orders"), "o_orderkey",
                                {"train": 0.7, "test": 0.3}, 27, "part")
    return parts.groupBy("part").agg(F.count("*").alias("n"),
                                     C.half_up(F.sum("o_totalprice"), 2).alias("total"))


_RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY label
 ORDER BY md5(CAST(custkey AS VARCHAR) || '|42'), custkey) AS rk, count(*) OVER (PARTITION BY label) AS n_group FROM scores)"""


@query("x3_stratified_split", Q.with_views(Q.SCORES, _RANKED) + """
SELECT custkey, label, rk <= ceil(0.8 * n_group) AS is_train FROM ranked""")
def x3(spark, d):
    return sampling.stratified_split(keep(views.scores(spark, d).select("custkey", "label")),
                                     "custkey", "label", 0.8)


@query("x4_stratified_folds", Q.with_views(Q.SCORES, _RANKED) + """
SELECT custkey, label, CAST((rk - 1) % 5 AS INTEGER) AS fold FROM ranked""")
def x4(spark, d):
    return sampling.stratified_folds(keep(views.scores(spark, d).select("custkey", "label")),
                                     "custkey", "label", 5)


_TIMES = " + ".join(f"CAST(u >= {e!r}::DOUBLE AS INTEGER)" for e in sampling.poisson_edges(2.0))


@query("x5_fraction_sample", f"""WITH drawn AS (SELECT o_orderkey, o_totalprice, {u_sql('o_orderkey')} AS u FROM orders)
SELECT o_orderkey, o_totalprice, FALSE AS replacement FROM drawn WHERE u < 0.3
UNION ALL SELECT o_orderkey, o_totalprice, TRUE FROM (SELECT *, unnest(range({_TIMES})) AS i FROM drawn)""")
def x5(spark, d):
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    once = sampling.fraction_sample(orders, "o_orderkey", 0.3).withColumn("replacement", F.lit(False))
    again = sampling.fraction_sample(orders, "o_orderkey", 2.0, True).withColumn("replacement", F.lit(True))
    return once.unionByName(again)


@query("x6_fixed_sample", """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|42'), o_orderkey LIMIT 1000""")
def x6(spark, d):
    return sampling.fixed_sample(tables.table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice"), "o_orderkey", 1000)


@query("x7_shuffle_rows", "SELECT o_orderkey, o_custkey FROM orders")
def x7(spark, d):
    return sampling.shuffle_rows(tables.table(spark, d, "orders").select(
        "o_orderkey", "o_custkey"), "o_orderkey", 99)
