"""Joins (J) and aggregations (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import aggregates as A
from propensity.operators import joins as J
from propensity.operators.ordered import exact_quantiles
from propensity.plans import view_sql as Q
from propensity.plans.column_queries import RISK_SQL, TIER_SQL, ltv_tier, risk_segment
from propensity.plans.registry import query, rnd
from propensity.sources import tables, views

# ---- joins ---------------------------------------------------------------------------


@query("j1_left_join", Q.with_views(Q.CUSTOMERS, Q.VIEWING) + f"""
SELECT subscriber_id, plan, days_active, {rnd('completion_rate', 6)} AS completion_rate
FROM customers LEFT JOIN viewing USING (custkey)""")
def j1(spark, d):
    v = views.viewing(spark, d)
    return (views.members(spark, d).join(v, "custkey", "left")
            .select("subscriber_id", "plan", "days_active",
                    C.half_up(F.col("completion_rate"), 6).alias("completion_rate")))


@query("j2_left_join_chain", Q.with_views(Q.SUBSCRIBERS, Q.VIEWING) + f"""
SELECT s.subscriber_id, s.plan, s.tenure_months, {rnd('s.monthly_fee_usd', 4)} AS monthly_fee_usd,
v.days_active, v.content_starts, p.support_tickets, p.payment_failures, p.plan_changes, o.churned
FROM subscribers s LEFT JOIN viewing v USING (custkey) LEFT JOIN support p USING (custkey)
LEFT JOIN order_features o USING (custkey)""")
def j2(spark, d):
    wide = J.left_chain(views.subscribers(spark, d),
                        [views.viewing(spark, d), views.support(spark, d),
                         views.churn_labels(spark, d)], "custkey")
    return wide.select("subscriber_id", "plan", "tenure_months",
                       C.half_up(F.col("monthly_fee_usd"), 4).alias("monthly_fee_usd"),
                       "days_active", "content_starts", "support_tickets", "payment_failures",
                       "plan_changes", "churned")


@query("j3_pruned_join", Q.with_views(Q.SCORES) + f"""
SELECT c.subscriber_id, c.plan, s.p_rf AS churn_probability, {RISK_SQL.format(p='s.p_rf')} AS risk_segment,
{TIER_SQL.format(x='o.total_spend / 4000')} AS ltv_tier
FROM customers c LEFT JOIN scores s USING (custkey) LEFT JOIN order_features o USING (custkey)""")
def j3(spark, d):
    risk = views.scores(spark, d).select("custkey", F.col("p_rf").alias("churn_probability"))
    value = views.order_features(spark, d).select(
        "custkey", (F.col("total_spend") / 4000).alias("value"))
    wide = J.left_chain(views.members(spark, d).select("custkey", "subscriber_id", "plan"),
                        [risk, value], "custkey")
    return wide.select("subscriber_id", "plan", "churn_probability",
                       risk_segment(F.col("churn_probability")).alias("risk_segment"),
                       ltv_tier(F.col("value")).alias("ltv_tier"))


@query("j4_join_back", Q.with_views(Q.SCORES) + """
SELECT c.custkey, c.plan, c.segment, s.p_gbm AS prob_churn,
CASE WHEN s.p_gbm >= 0.5 THEN 'Churn' WHEN s.p_gbm < 0.5 THEN 'Active' END AS prediction
FROM customers c LEFT JOIN scores s USING (custkey)""")
def j4(spark, d):
    scored = views.scores(spark, d).select(
        "custkey", "plan", F.col("p_gbm").alias("prob_churn"),
        C.threshold_label(F.col("p_gbm"), 0.5, "Churn", "Active").alias("prediction"))
    return J.join_back(views.members(spark, d).select("custkey", "plan", "segment"),
                       scored, "custkey")


YEARS = range(1992, 1999)


@query("j5_full_outer_list", "SELECT custkey, " + ", ".join(f"n_{y}" for y in YEARS) + " FROM " + " FULL JOIN ".join(
    f"(SELECT o_custkey AS custkey, count(*) AS n_{y} FROM orders WHERE year(o_orderdate) = {y} GROUP BY 1) y{y}"
    + (" USING (custkey)" if y > YEARS[0] else "") for y in YEARS))
def j5(spark, d):
    orders = tables.table(spark, d, "orders")

    def of_year(y):
        lo, hi = (F.lit(f"{v}-01-01").cast("timestamp_ntz") for v in (y, y + 1))
        day = F.col("o_orderdate")
        return (orders.filter((day >= lo) & (day < hi))
                .groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias(f"n_{y}")))

    return J.full_outer([of_year(y) for y in YEARS], "custkey")


@query("j6_keyed_bind", Q.with_views(Q.SCORES) + """
SELECT custkey, label AS actual, CAST(p_rf >= 0.5 AS INTEGER) AS predicted FROM scores""")
def j6(spark, d):
    s = views.scores(spark, d)
    actual = s.select("custkey", F.col("label").alias("actual"))
    predicted = s.select("custkey", C.flag(F.col("p_rf") >= 0.5).alias("predicted"))
    return actual.join(predicted, "custkey")


@query("j7_edge_endpoints", """
WITH edges AS (SELECT s_nationkey AS f, c_nationkey AS t, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT f AS "from", t AS "to", n, a.n_name AS from_n_name, b.n_name AS to_n_name
FROM edges LEFT JOIN nation a ON f = a.n_nationkey LEFT JOIN nation b ON t = b.n_nationkey""")
def j7(spark, d):
    lines = (tables.table(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey")
             .agg(F.count("*").alias("n")))
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    cust = tables.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("to"))
    supp = tables.table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("from"))
    edges = (lines.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
             .groupBy("l_orderkey", "from").agg(F.sum("n").alias("n"))
             .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("o_custkey", "from").agg(F.sum("n").alias("n"))
             .join(cust, F.col("o_custkey") == F.col("c_custkey"))
             .groupBy("from", "to").agg(F.sum("n").alias("n")))
    return J.with_endpoints(edges, tables.table(spark, d, "nation"), "n_nationkey", ["n_name"])


@query("j8_parameter_grid", """
SELECT c_mktsegment, n, ntree, mtry, nodesize
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1),
(VALUES (200), (500)) a(ntree), (VALUES (3), (5), (7)) b(mtry), (VALUES (1), (5), (10)) c(nodesize)""")
def j8(spark, d):
    strata = tables.table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return J.parameter_grid(strata, {"ntree": [200, 500], "mtry": [3, 5, 7],
                                     "nodesize": [1, 5, 10]})


# ---- aggregations --------------------------------------------------------------------

@query("a1_group_count", Q.with_views(Q.CUSTOMERS) + "SELECT plan, count(*) AS n FROM customers GROUP BY 1")
def a1(spark, d):
    return A.group_summary(views.members(spark, d), "plan")


@query("a2_group_mean", Q.with_views(Q.SCORES) + f"""
SELECT {RISK_SQL.format(p='p_rf')} AS risk_segment, count(*) AS n, {rnd('avg(p_rf)', 6)} AS avg_prob
FROM customers LEFT JOIN scores USING (custkey) GROUP BY 1""")
def a2(spark, d):
    df = views.members(spark, d).join(views.scores(spark, d).select("custkey", "p_rf"),
                                        "custkey", "left")
    return A.group_summary(df.withColumn("risk_segment", risk_segment(F.col("p_rf"))),
                           "risk_segment", {"avg_prob": "p_rf"}, {"avg_prob": 6})


@query("a3_rounded_means_ordered", Q.with_views(Q.SCORES) + f"""
SELECT plan, count(*) AS n, {rnd('avg(p_gbm)', 3)} AS avg_churn_pr, {rnd('avg(label)', 3)} AS churn_rate
FROM scores GROUP BY 1 ORDER BY n DESC, plan""")
def a3(spark, d):
    out = A.group_summary(views.scores(spark, d), "plan",
                          {"avg_churn_pr": "p_gbm", "churn_rate": "label"},
                          {"avg_churn_pr": 3, "churn_rate": 3})
    return out.orderBy(F.desc("n"), "plan")


@query("a4_class_balance", Q.with_views(Q.SCORES) + f"""
SELECT label, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 4)} AS pct
FROM scores GROUP BY 1""")
def a4(spark, d):
    return A.class_balance(views.scores(spark, d), "label").withColumn(
        "pct", C.half_up(F.col("pct"), 4))


@query("a5_null_counts", Q.with_views(Q.CHURN) + "SELECT " + ", ".join(
    f'count(*) FILTER ("{c}" IS NULL) AS "{c}"' for c in
    ("CustomerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract", "InternetService",
     "PaymentMethod", "Churn")) + " FROM churn")
def a5(spark, d):
    return A.null_counts(views.churn(spark, d))


@query("a6_class_means", Q.with_views(Q.CHURN) + f"""
SELECT "Churn", {rnd('avg(tenure)', 4)} AS tenure, {rnd('avg("MonthlyCharges")', 4)} AS "MonthlyCharges",
{rnd('avg("TotalCharges")', 4)} AS "TotalCharges" FROM churn
WHERE tenure IS NOT NULL AND "MonthlyCharges" IS NOT NULL AND "TotalCharges" IS NOT NULL GROUP BY 1""")
def a6(spark, d):
    out = A.class_means(views.churn(spark, d).drop("CustomerID"), "Churn")
    return out.select("Churn", *[C.half_up(F.col(c), 4).alias(c) for c in out.columns[1:]])


@query("a7_row_count", "SELECT count(*) AS n FROM lineitem")
def a7(spark, d):
    return tables.table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("a8_conditional_counts", Q.with_views(Q.SCORES) + """
SELECT count(*) AS total, count(*) FILTER (label = 1) AS n_churn, count(*) FILTER (label = 0) AS n_active,
count(*) FILTER (p_rf >= 0.5) AS predicted_churn FROM scores""")
def a8(spark, d):
    return views.scores(spark, d).agg(
        F.count("*").alias("total"), F.count_if(F.col("label") == 1).alias("n_churn"),
        F.count_if(F.col("label") == 0).alias("n_active"),
        F.count_if(F.col("p_rf") >= 0.5).alias("predicted_churn"))


@query("a9_contingency", Q.with_views(Q.SCORES) + """
SELECT label AS actual, count(*) FILTER (p_rf < 0.5) AS n_0, count(*) FILTER (p_rf >= 0.5) AS n_1
FROM scores GROUP BY 1""")
def a9(spark, d):
    df = views.scores(spark, d).select(F.col("label").alias("actual"),
                                       C.flag(F.col("p_rf") >= 0.5).alias("predicted"))
    return A.contingency(df, "actual", "predicted", [0, 1])


_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a10_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, {rnd(f'quantile_cont({c}, 0.25)', 4)} AS q1,
{rnd(f'median({c})', 4)} AS median, {rnd(f'avg({c})', 4)} AS mean, {rnd(f'quantile_cont({c}, 0.75)', 4)} AS q3,
max({c}) AS max FROM lineitem""" for c in _PROFILE_COLS))
def a10(spark, d):
    out = A.profile(tables.table(spark, d, "lineitem").select(*_PROFILE_COLS), _PROFILE_COLS)
    return out.select("column", "n", "min", "max", *[
        C.half_up(F.col(c), 4).alias(c) for c in ("q1", "median", "mean", "q3")])


@query("a11_exact_quantile", f"""
SELECT event_type, {rnd('quantile_cont(value, 0.95)', 4)} AS q95, {rnd('median(value)', 4)} AS median
FROM events GROUP BY 1""")
def a11(spark, d):
    out = exact_quantiles(tables.table(spark, d, "events"), "value",
                          {"q95": 0.95, "median": 0.5}, ["event_type"])
    return out.select("event_type", *[C.half_up(F.col(c), 4).alias(c) for c in ("q95", "median")])


@query("a12_squared_correlation", f"""
SELECT {rnd('corr(l_quantity, l_extendedprice)', 6)} AS r, {rnd('pow(corr(l_quantity, l_extendedprice), 2)', 6)} AS r2,
{rnd('regr_r2(l_extendedprice, l_quantity)', 6)} AS regr_r2 FROM lineitem""")
def a12(spark, d):
    r = F.corr("l_quantity", "l_extendedprice")
    return tables.table(spark, d, "lineitem").agg(
        C.half_up(r, 6).alias("r"), C.half_up(r * r, 6).alias("r2"),
        C.half_up(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("regr_r2"))


def _pair_sql(fn: str, cols: list[str], source: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(f'{fn}({a}, {b})', digits)} AS value FROM {source}"
        for a in cols for b in cols)


@query("a13_correlation_matrix", _pair_sql("corr", _PROFILE_COLS, "lineitem", 6))
def a13(spark, d):
    out = A.full_matrix(A.pair_statistics(tables.table(spark, d, "lineitem"), _PROFILE_COLS))
    return out.withColumn("value", C.half_up(F.col("value"), 6))


@query("a14_covariance_matrix", _pair_sql("covar_samp", ["l_quantity", "l_discount", "l_tax"], "lineitem", 6)
       + "".join(f" UNION ALL SELECT '{c}', 'mean', {rnd(f'avg({c})', 6)} FROM lineitem"
                 for c in ("l_quantity", "l_discount", "l_tax")))
def a14(spark, d):
    cols = ["l_quantity", "l_discount", "l_tax"]
    lines = tables.table(spark, d, "lineitem")
    cov = A.full_matrix(A.pair_statistics(lines, cols, "covar"))
    means = A.column_spread(lines, cols).select(
        F.col("feature").alias("col_a"), F.lit("mean").alias("col_b"), F.col("mean").alias("value"))
    return cov.unionByName(means).withColumn("value", C.half_up(F.col("value"), 6))


@query("a15_column_spread", Q.with_views(Q.SCORES) + " UNION ALL ".join(
    f"SELECT 'p_{m}' AS feature, {rnd(f'avg(p_{m})', 6)} AS mean, {rnd(f'stddev_samp(p_{m})', 6)} AS sd FROM scores"
    for m in views.MODELS))
def a15(spark, d):
    out = A.column_spread(views.scores(spark, d), [f"p_{m}" for m in views.MODELS])
    return out.select("feature", *[C.half_up(F.col(c), 6).alias(c) for c in ("mean", "sd")])


@query("a16_bin_means", Q.with_views(Q.SCORES) + f"""
SELECT CAST(greatest(ceil(p_lgb * 10), 1) AS INTEGER) AS bin, count(*) AS n, {rnd('avg(p_lgb)', 6)} AS mean_p,
{rnd('avg(label)', 6)} AS mean_y FROM scores GROUP BY 1""")
def a16(spark, d):
    out = A.bin_means(views.scores(spark, d), "p_lgb", "label")
    return out.select("bin", "n", *[C.half_up(F.col(c), 6).alias(c) for c in ("mean_p", "mean_y")])


@query("a17_histogram", Q.with_views(Q.SCORES) + f"""
SELECT plan, bin, n, {rnd('n / sum(n) OVER (PARTITION BY plan) / 0.05', 6)} AS density
FROM (SELECT plan, CAST(least(floor((p_rf - 0.0) / 0.05::DOUBLE), 19) AS INTEGER) AS bin, count(*) AS n
FROM scores GROUP BY 1, 2)""")
def a17(spark, d):
    out = A.histogram(views.scores(spark, d), "p_rf", 0.0, 1.0, 20, ["plan"])
    return out.withColumn("density", C.half_up(F.col("density"), 6))
