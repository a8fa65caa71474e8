"""Feature preparation (F) and class balance (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import balance as B
from propensity.operators import features as X
from propensity.operators import sampling
from propensity.operators import subscribers as S
from propensity.plans import view_sql as Q
from propensity.plans.order_queries import u_sql
from propensity.plans.registry import query, rnd
from propensity.session import keep
from propensity.sources import tables, views

CHARGES = ["tenure", "MonthlyCharges", "TotalCharges"]


def _rounded(df, cols, digits=4):
    return df.select(*[C.half_up(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


@query("f1_median_imputation", Q.with_views(Q.CHURN) + "SELECT \"CustomerID\", " + ", ".join(
    rnd(f'coalesce("{c}", (SELECT median("{c}") FROM churn))', 4) + f' AS "{c}"' for c in CHARGES)
       + " FROM churn")
def f1(spark, d):
    df = keep(views.churn(spark, d).select("CustomerID", *CHARGES))
    return _rounded(X.impute(df, X.medians(df, CHARGES), CHARGES), CHARGES)


@query("f2_training_medians", Q.with_views(Q.CHURN, f"""train AS (SELECT * FROM churn WHERE {u_sql('"CustomerID"')} < 0.8),
new AS (SELECT * FROM churn WHERE NOT {u_sql('"CustomerID"')} < 0.8)""") + "SELECT \"CustomerID\", " + ", ".join(
    rnd(f'coalesce("{c}", (SELECT median("{c}") FROM train))', 4) + f' AS "{c}"' for c in CHARGES)
       + " FROM new")
def f2(spark, d):
    df = keep(views.churn(spark, d).select("CustomerID", *CHARGES))
    train, new = sampling.random_split(df, "CustomerID", [0.8, 0.2])
    return _rounded(X.impute(new, X.medians(train, CHARGES), CHARGES), CHARGES)


@query("f3_string_index", """
SELECT o_orderkey, CAST(a.i AS DOUBLE) AS by_count, CAST(b.i AS DOUBLE) AS by_name FROM orders
JOIN (SELECT o_orderpriority AS l, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM orders GROUP BY 1) a ON a.l = o_orderpriority
JOIN (SELECT o_orderpriority AS l, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i FROM orders GROUP BY 1) b ON b.l = o_orderpriority""")
def f3(spark, d):
    df = tables.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    by_count = X.index_strings(df, ["o_orderpriority"]).transform(df)
    by_count = by_count.withColumnRenamed("o_orderpriority_idx", "by_count")
    both = X.index_strings(df, ["o_orderpriority"], "alphabetAsc").transform(by_count)
    return both.select("o_orderkey", "by_count", F.col("o_orderpriority_idx").alias("by_name"))


@query("f4_one_hot", """SELECT l_orderkey, l_linenumber, l_partkey, """ + ", ".join(
    f"CAST({c} = '{v}' AS INTEGER) AS \"{c}_{v}\"" for c, vs in
    (("l_returnflag", "ANR"), ("l_linestatus", "FO")) for v in vs) + " FROM lineitem")
def f4(spark, d):
    df = tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    return X.dummies(df, df, ["l_returnflag", "l_linestatus"])


@query("f5_design_matrix", Q.with_views(Q.SUBSCRIBERS, """base AS (SELECT o.*, c.plan FROM order_features o
JOIN customers c USING (custkey) WHERE n_orders > 0)""", """lev AS (SELECT plan, row_number() OVER (ORDER BY count(*) DESC, plan) AS rk
FROM base GROUP BY 1)""") + """
SELECT custkey, CAST(churned AS DOUBLE) AS label, CAST(n_orders AS DOUBLE) AS x0, CAST(tenure_months AS DOUBLE) AS x1,
CAST(rk = 1 AS DOUBLE) AS x2, CAST(rk = 2 AS DOUBLE) AS x3, CAST(rk = 3 AS DOUBLE) AS x4 FROM base JOIN lev USING (plan)""")
def f5(spark, d):
    df = (views.order_features(spark, d).filter(F.col("n_orders") > 0)
          .join(views.members(spark, d).select("custkey", "plan"), "custkey")
          .select("custkey", "churned", "n_orders", "tenure_months", "plan"))
    out = X.design(df, "churned", ["n_orders", "tenure_months", "plan"])
    x = X.vector_to_array("features")
    return out.select("custkey", "label", *[x[i].alias(f"x{i}") for i in range(5)])


@query("f6_assembled_vector", Q.with_views(Q.SUBSCRIBERS) + """
SELECT custkey, balance AS x0, CAST(coalesce(CAST(n_orders AS DOUBLE), 'NaN') AS DOUBLE) AS x1,
CAST(coalesce(CAST(tenure_months AS DOUBLE), 'NaN') AS DOUBLE) AS x2 FROM subscribers""")
def f6(spark, d):
    out = X.assemble(views.subscribers(spark, d), ["balance", "n_orders", "tenure_months"])
    x = X.vector_to_array("features")
    return out.select("custkey", *[x[i].alias(f"x{i}") for i in range(3)])


LOAN_NUMERIC = ["l_quantity", "l_discount", "l_tax"]


@query("f7_min_max_scale", f"""WITH t AS (SELECT *, {u_sql('l_orderkey', 27)} AS u FROM lineitem),
m AS (SELECT """ + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in LOAN_NUMERIC)
       + " FROM t WHERE u < 0.7) SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
           rnd(f"({c} - lo_{c}) / (hi_{c} - lo_{c})", 4) + f" AS {c}" for c in LOAN_NUMERIC) + " FROM t, m")
def f7(spark, d):
    df = views.loans(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *LOAN_NUMERIC)
    train, _ = sampling.random_split(df, "l_orderkey", [0.7, 0.3], 27)
    return _rounded(X.scaled(df, train, LOAN_NUMERIC), LOAN_NUMERIC)


@query("f8_standardise", "WITH m AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LOAN_NUMERIC)
       + " FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
           rnd(f"({c} - m_{c}) / s_{c}", 4) + f" AS {c}" for c in LOAN_NUMERIC) + " FROM lineitem, m")
def f8(spark, d):
    df = views.loans(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *LOAN_NUMERIC)
    return _rounded(X.scaled(df, df, LOAN_NUMERIC, "standard"), LOAN_NUMERIC)


@query("f9_align_levels", """SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM part WHERE p_size > 48)
THEN p_brand END AS p_brand FROM part""")
def f9(spark, d):
    part = tables.table(spark, d, "part")
    levels = X.level_table(part.filter(F.col("p_size") > 48), "p_brand")
    return X.align_levels(part.select("p_partkey", "p_brand"), levels, "p_brand")


NZV = ["l_quantity", "l_tax", "l_returnflag", "l_linestatus", "high_discount"]


@query("f10_near_zero_variance", f"""WITH t AS (SELECT CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_tax AS VARCHAR) AS l_tax,
l_returnflag, l_linestatus, CAST(CAST(l_extendedprice > 100000 AS INTEGER) AS VARCHAR) AS high_discount FROM lineitem),
l AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, count(*) AS n FROM t GROUP BY 2" for c in NZV)
       + f"""), r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS rk FROM l),
s AS (SELECT feature, coalesce(max(n) FILTER (rk = 1) / CAST(max(n) FILTER (rk = 2) AS DOUBLE), 0) AS fr,
 count(*) * 100.0 / sum(n) AS pct, count(*) AS levels FROM r GROUP BY 1)
SELECT feature, {rnd('fr', 4)} AS freq_ratio, {rnd('pct', 4)} AS pct_unique,
 (fr > 19 AND pct < 10) OR levels = 1 AS "drop" FROM s""")
def f10(spark, d):
    df = tables.table(spark, d, "lineitem").withColumn(
        "high_discount", C.flag(F.col("l_extendedprice") > 100000))
    return _rounded(X.near_zero_variance(df, NZV), ["freq_ratio", "pct_unique"])


COR = ["tenure", "tenure_sq", "MonthlyCharges", "n_orders", "total_spend"]


@query("f11_correlated_columns", Q.with_views(Q.SUBSCRIBERS, """t AS (SELECT tenure_months AS tenure,
tenure_months * tenure_months AS tenure_sq, monthly_fee_usd * 3 AS "MonthlyCharges", n_orders, total_spend
FROM order_features WHERE n_orders > 0), p AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr(\"{a}\", \"{b}\")) AS r FROM t" for a in COR for b in COR if a != b)
       + """), m AS (SELECT a, avg(r) AS mean_r FROM p GROUP BY 1)""") + """
SELECT CASE WHEN x.mean_r > y.mean_r THEN p.a ELSE p.b END AS feature FROM p JOIN m x ON x.a = p.a JOIN m y ON y.a = p.b
WHERE p.a < p.b AND r > 0.9""")
def f11(spark, d):
    df = (views.order_features(spark, d).filter(F.col("n_orders") > 0)
          .select(F.col("tenure_months").alias("tenure"),
                  (F.col("tenure_months") * F.col("tenure_months")).alias("tenure_sq"),
                  (F.col("monthly_fee_usd") * 3).alias("MonthlyCharges"), "n_orders", "total_spend"))
    drop = X.correlated_columns(df, COR)
    return spark.createDataFrame([(c,) for c in drop], "feature string")


@query("f13_subscriber_features", Q.with_views(Q.FEATURES, """e AS (SELECT *, avg_daily_hours / 3 * completion_rate AS eng FROM features)""") + f"""
SELECT subscriber_id, {rnd('eng', 4)} AS engagement_score, CAST(days_active < 10 AS INTEGER) AS low_activity,
{rnd('monthly_fee_usd * CASE WHEN tenure_months IS NOT NULL THEN greatest(1, tenure_months + 12 * eng) END * greatest(0.5, 1 - 0.1 * support_tickets)', 4)} AS estimated_ltv_usd,
CAST(avg_daily_hours * 0.4 + completion_rate * 0.3 + days_active / 30 * 0.3 > 0.45 AS INTEGER) AS converted,
CAST(avg_daily_hours * 0.35 + plan_changes * 0.04 + completion_rate * 0.25 + tenure_months * 0.005 > 0.5 AS INTEGER) AS upgraded
FROM e""")
def f13(spark, d):
    df = views.subscriber_features(spark, d).withColumn("genres_watched", F.col("plan_changes"))
    df = S.upgrade_label(S.conversion_label(S.plan_flags(S.value_columns(df))))
    return _rounded(df.select("subscriber_id", "engagement_score", "low_activity",
                              "estimated_ltv_usd", "converted", "upgraded"),
                    ["engagement_score", "estimated_ltv_usd"])


@query("f14_fraud_signals", Q.with_views(Q.FEATURES) + f"""
SELECT subscriber_id, CAST(login_failures > 5 AS INTEGER) AS unusual_login, CAST(payment_failures > 2 AS INTEGER) AS payment_issues,
CAST(avg_daily_hours < 0.1 AND content_starts < 10 AS INTEGER) AS low_content,
CAST(device_type = 'web' AND content_starts > 100 AS INTEGER) AS multi_device,
{rnd('login_failures * 0.3 + payment_failures * 0.4 + CAST(avg_daily_hours < 0.1 AS INTEGER) * 0.3', 4)} AS fraud_score_raw FROM features""")
def f14(spark, d):
    df = S.fraud_signals(views.subscriber_features(spark, d))
    return _rounded(df.select("subscriber_id", "unusual_login", "payment_issues", "low_content",
                              "multi_device", "fraud_score_raw"), ["fraud_score_raw"])


# ---- class balance -------------------------------------------------------------------

def _labelled(spark, d):
    """Written once: the class sizes, the ranks and the rows all read it."""
    return keep(views.scores(spark, d).select("custkey", "label", "p_rf", "p_gbm", "p_lgb"))


@query("b1_class_weight", Q.with_views(Q.SCORES) + f"""
SELECT custkey, label, {rnd('count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label))', 6)} AS class_weight FROM scores""")
def b1(spark, d):
    out = B.add_class_weight(_labelled(spark, d), "label")
    return _rounded(out.select("custkey", "label", "class_weight"), ["class_weight"], 6)


@query("b2_positive_weight", f"""SELECT doc_id, quality,
{rnd('CASE WHEN quality = 1 THEN (SELECT CAST(count(*) FILTER (quality = 0) AS DOUBLE) / count(*) FILTER (quality = 1) FROM labels) ELSE 1.0 END', 6)} AS pos_weight
FROM labels""")
def b2(spark, d):
    out = B.add_positive_weight(tables.table(spark, d, "labels"), "quality")
    return _rounded(out.select("doc_id", "quality", "pos_weight"), ["pos_weight"], 6)


_GROUPS = """g AS (SELECT custkey, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(custkey AS VARCHAR) || '|42'), custkey) AS rk,
count(*) OVER (PARTITION BY label) AS n, (SELECT greatest(sum(label), count(*) - sum(label)) FROM scores) AS hi,
(SELECT least(sum(label), count(*) - sum(label)) FROM scores) AS lo FROM scores)"""


@query("b3_oversample", Q.with_views(Q.SCORES, _GROUPS) + """
SELECT custkey, label, CAST(unnest(range(1, CAST(hi // n + CASE WHEN rk <= hi % n THEN 1 ELSE 0 END AS BIGINT) + 1)) AS INTEGER) AS copy FROM g""")
def b3(spark, d):
    return B.oversample(_labelled(spark, d).select("custkey", "label"), "custkey", "label")


@query("b4_undersample", Q.with_views(Q.SCORES, _GROUPS) + """
SELECT custkey, label, 1 AS copy FROM g WHERE rk <= lo""")
def b4(spark, d):
    return B.undersample(_labelled(spark, d).select("custkey", "label"), "custkey", "label")


@query("b5_smoothed_bootstrap")
def b5(spark, d):
    return B.smoothed_bootstrap(_labelled(spark, d), "custkey", "label", ["p_rf", "p_gbm", "p_lgb"])


@query("b6_minority_interpolation")
def b6(spark, d):
    df = keep(views.churn(spark, d).select("CustomerID", "Churn", "tenure", "MonthlyCharges"))
    return B.interpolate_minority(df, "CustomerID", "Churn", ["tenure", "MonthlyCharges"])


_LABEL_COUNTS = """g AS (SELECT count(*) AS n, sum(label) AS n1 FROM scores)"""


@query("b5_class_counts", Q.with_views(Q.SCORES) + f"""
SELECT CAST({u_sql('custkey', 52)} < 0.5 AS INTEGER) AS label, count(*) AS n FROM scores GROUP BY 1""")
def b5_counts(spark, d):
    out = B.smoothed_bootstrap(_labelled(spark, d), "custkey", "label", ["p_rf", "p_gbm", "p_lgb"])
    return out.groupBy("label").agg(F.count("*").alias("n"))


@query("b6_origin_counts", Q.with_views(Q.SCORES, _LABEL_COUNTS) + """
SELECT 'minority' AS origin, CAST(n1 AS BIGINT) AS n FROM g UNION ALL SELECT 'synthetic', CAST(2 * n1 AS BIGINT) FROM g
UNION ALL SELECT 'majority', CAST(floor(2 * n1 * 150 / 100) AS BIGINT) FROM g""")
def b6_counts(spark, d):
    out = B.interpolate_minority(_labelled(spark, d), "custkey", "label", ["p_rf", "p_gbm", "p_lgb"])
    return out.groupBy("origin").agg(F.count("*").alias("n"))
