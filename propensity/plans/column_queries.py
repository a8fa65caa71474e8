"""Sources and sinks (S) and column expressions (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V
from propensity.operators.features import charge_columns
from propensity.plans import view_sql as Q
from propensity.plans.registry import query, rnd
from propensity.session import new_path
from propensity.sources import sinks, tables, views

# ---- sources and sinks ---------------------------------------------------------------

_ORDERS_BY_STATUS = """SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total
FROM orders GROUP BY 1"""


def _by_status(df):
    return df.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("s1_csv_scan", _ORDERS_BY_STATUS)
def s1(spark, d):
    orders = tables.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = sinks.write_csv(orders, new_path(spark, "orders-csv"))
    return _by_status(tables.read_csv(spark, path, orders.schema))


@query("s2_parquet_scan", """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty
FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2""")
def s2(spark, d):
    lines = tables.table(spark, d, "lineitem").filter(
        F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("s3_catalog_scan", _ORDERS_BY_STATUS)
def s3(spark, d):
    path = new_path(spark, "orders-table")
    name = "orders_" + path[-32:]
    sinks.write_named(tables.table(spark, d, "orders").select("o_orderstatus", "o_totalprice"),
                      name, path)
    return _by_status(tables.read_named(spark, name))


@query("s4_path_dataset_scan", """SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def s4(spark, d):
    return tables.load_dataset(spark, f"{d}/events.parquet").groupBy("event_type").agg(
        F.count("*").alias("n"))


_SCORED_SQL = (Q.with_views(Q.SCORES)
               + """SELECT subscriber_id, p_rf,
CASE WHEN p_rf >= 0.5 THEN 'Churn' ELSE 'Active' END AS prediction FROM scores""")


def _scored(spark, d):
    return views.scores(spark, d).select(
        "subscriber_id", "p_rf",
        C.threshold_label(F.col("p_rf"), 0.5, "Churn", "Active").alias("prediction"))


@query("s5_parquet_sink", _SCORED_SQL)
def s5(spark, d):
    path = sinks.write_dataset(_scored(spark, d), new_path(spark, "scores"))
    return tables.load_dataset(spark, path)


@query("s6_csv_sink", _SCORED_SQL)
def s6(spark, d):
    df = _scored(spark, d)
    path = sinks.write_csv(df, new_path(spark, "scores-csv"))
    return tables.read_csv(spark, path, df.schema)


@query("s7_format_sink", Q.with_views(Q.SCORES) + """, f AS (SELECT subscriber_id, p_rf,
CASE WHEN p_rf >= 0.5 THEN 'Churn' ELSE 'Active' END AS prediction FROM scores)
SELECT * FROM f UNION ALL SELECT * FROM f WHERE prediction = 'Churn'""")
def s7(spark, d):
    path = new_path(spark, "scores-any")
    df = _scored(spark, d)
    sinks.write_dataset(df, path, "parquet", "overwrite")
    sinks.write_dataset(df.filter(F.col("prediction") == "Churn"), path, "parquet", "append")
    return tables.load_dataset(spark, path)


@query("s8_managed_table_sink", _SCORED_SQL)
def s8(spark, d):
    path = new_path(spark, "scores-table")
    name = "scores_" + path[-32:]
    sinks.write_named(_scored(spark, d), name, path)
    return tables.read_named(spark, name)


@query("s9_date_partition_append", Q.with_views(Q.SCORES) + """
SELECT subscriber_id, p_rf, CASE WHEN p_rf >= 0.5 THEN 'Churn' ELSE 'Active' END AS prediction,
       score_date FROM scores, (VALUES ('2024-01-30'), ('2024-01-31')) t(score_date)""")
def s9(spark, d):
    path = new_path(spark, "scores-by-date")
    df = _scored(spark, d)
    for date in ("2024-01-30", "2024-01-31", "2024-01-31"):  # the repeat must not add rows
        sinks.append_by_date(df, path, date)
    return tables.load_dataset(spark, path, schema=df.schema.add("score_date", "string"))


@query("s10_register_rows", """SELECT plan, count(*) AS n, min(list_fee) AS list_fee
FROM (SELECT CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'trial' WHEN 'BUILDING' THEN 'basic'
      WHEN 'FURNITURE' THEN 'standard' WHEN 'AUTOMOBILE' THEN 'standard' ELSE 'premium' END AS plan
      FROM customer)
JOIN (VALUES ('trial', 0.0::DOUBLE), ('basic', 5.0), ('standard', 12.5), ('premium', 25.0)) p(plan, list_fee)
USING (plan) GROUP BY 1""")
def s10(spark, d):
    name = "plan_fees"
    fees = sinks.register_rows(
        spark, [("trial", 0.0), ("basic", 5.0), ("standard", 12.5), ("premium", 25.0)],
        "plan string, list_fee double", name)
    subs = views.members(spark, d).select("plan")
    return subs.join(fees, "plan").groupBy("plan").agg(
        F.count("*").alias("n"), F.min("list_fee").alias("list_fee"))


@query("s11_named_cache", Q.with_views(Q.SCORES) + """
SELECT plan, count(*) AS n, sum(label)::BIGINT AS churned FROM scores GROUP BY 1""")
def s11(spark, d):
    hot = sinks.cache_named(views.scores(spark, d).select("plan", "label"), "hot_scores")
    return hot.groupBy("plan").agg(F.count("*").alias("n"), F.sum("label").alias("churned"))


@query("s12_write_check", Q.with_views(Q.SCORES) + """
SELECT CASE WHEN p_rf >= 0.5 THEN 'Churn' ELSE 'Active' END AS prediction, count(*) AS n
FROM scores GROUP BY 1""")
def s12(spark, d):
    path = new_path(spark, "scores-check")
    name = "check_" + path[-32:]
    sinks.write_named(_scored(spark, d), name, path)
    return sinks.class_counts(tables.read_named(spark, name), "prediction")


# ---- column expressions --------------------------------------------------------------

@query("p1_select_rename", Q.with_views(Q.SCORES)
       + "SELECT subscriber_id, p_rf AS churn_probability FROM scores")
def p1(spark, d):
    return C.select_as(views.scores(spark, d),
                       {"subscriber_id": "subscriber_id", "churn_probability": "p_rf"})


@query("p2_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def p2(spark, d):
    return tables.table(spark, d, "orders").drop("o_totalprice", "o_orderdate", "o_orderpriority")


@query("p3_numeric_projection", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
l_extendedprice, l_discount, l_tax FROM lineitem""")
def p3(spark, d):
    lines = tables.table(spark, d, "lineitem")
    return lines.select(*C.numeric_columns(lines))


@query("p4_derived_columns", Q.with_views(Q.CHURN, Q.VIEWING) + f"""
SELECT "CustomerID", tenure * tenure AS tenure_sq,
{rnd('"TotalCharges" / CASE WHEN tenure > 0 THEN tenure ELSE 1 END', 4)} AS avg_charges,
CAST("MonthlyCharges" > 70 AS INTEGER) AS high_value,
{rnd('"MonthlyCharges" / CASE WHEN "TotalCharges" > 0 THEN "TotalCharges" ELSE 1 END', 4)} AS charge_ratio,
{rnd('v.avg_daily_hours / 3 * v.completion_rate', 4)} AS engagement_score
FROM churn LEFT JOIN viewing v ON v.custkey = "CustomerID\"""")
def p4(spark, d):
    df = charge_columns(views.churn(spark, d))
    v = views.viewing(spark, d).select(
        F.col("custkey").alias("CustomerID"),
        (F.col("avg_daily_hours") / 3 * F.col("completion_rate")).alias("engagement_score"))
    return df.join(v, "CustomerID", "left").select(
        "CustomerID", "tenure_sq", C.half_up(F.col("avg_charges"), 4).alias("avg_charges"),
        "high_value", C.half_up(F.col("charge_ratio"), 4).alias("charge_ratio"),
        C.half_up(F.col("engagement_score"), 4).alias("engagement_score"))


@query("p5_flags", Q.with_views(Q.SUBSCRIBERS, Q.VIEWING) + """
SELECT s.subscriber_id, CAST(plan = 'trial' AS INTEGER) AS is_trial,
CAST(plan = 'premium' AS INTEGER) AS is_premium,
CAST(days_active < 10 AS INTEGER) AS low_activity
FROM subscribers s LEFT JOIN viewing USING (custkey)""")
def p5(spark, d):
    df = views.members(spark, d).join(
        views.viewing(spark, d).select("custkey", "days_active"), "custkey", "left")
    return df.select("subscriber_id", C.flag(F.col("plan") == "trial").alias("is_trial"),
                     C.flag(F.col("plan") == "premium").alias("is_premium"),
                     C.flag(F.col("days_active") < V.LOW_ACTIVITY_DAYS).alias("low_activity"))


def risk_segment(p):
    return C.first_match([(p >= cut, label) for cut, label in V.CHURN_RISK], V.CHURN_RISK_DEFAULT)


def ltv_tier(x):
    return C.first_match([(x >= cut, label) for cut, label in V.LTV_TIERS], V.LTV_TIER_DEFAULT)


RISK_SQL = """CASE WHEN {p} >= 0.70 THEN 'High' WHEN {p} >= 0.40 THEN 'Medium' ELSE 'Low' END"""
TIER_SQL = """CASE WHEN {x} >= 500 THEN 'Platinum' WHEN {x} >= 250 THEN 'Gold'
WHEN {x} >= 100 THEN 'Silver' ELSE 'Bronze' END"""


@query("p6_first_match_label", Q.with_views(Q.SCORES)
       + f"""SELECT c.subscriber_id, {RISK_SQL.format(p='p_rf')} AS risk_segment
FROM customers c LEFT JOIN scores USING (custkey)""")
def p6(spark, d):
    df = views.members(spark, d).join(views.scores(spark, d).select("custkey", "p_rf"),
                                        "custkey", "left")
    return df.select("subscriber_id", risk_segment(F.col("p_rf")).alias("risk_segment"))


@query("p7_safe_division", Q.with_views(Q.CHURN) + f"""
SELECT "CustomerID", {rnd('"TotalCharges" / CASE WHEN tenure > 0 THEN tenure ELSE 1 END', 4)} AS by_positive,
{rnd('"TotalCharges" / greatest(tenure, 1)', 4)} AS by_at_least_one FROM churn""")
def p7(spark, d):
    total, tenure = F.col("TotalCharges"), F.col("tenure")
    return views.churn(spark, d).select(
        "CustomerID", C.half_up(C.per_positive(total, tenure), 4).alias("by_positive"),
        C.half_up(C.per_at_least_one(total, tenure), 4).alias("by_at_least_one"))


@query("p8_lower_bound", Q.with_views(Q.SUBSCRIBERS, Q.VIEWING) + f"""
SELECT s.subscriber_id,
{rnd("CASE WHEN tenure_months + avg_daily_hours * completion_rate IS NOT NULL THEN greatest(1, tenure_months + 12 * avg_daily_hours / 3 * completion_rate) END", 4)} AS months,
{rnd("CASE WHEN support_tickets IS NOT NULL THEN greatest(0.5, 1 - 0.1 * support_tickets) END", 4)} AS factor
FROM subscribers s LEFT JOIN viewing USING (custkey) LEFT JOIN support USING (custkey)""")
def p8(spark, d):
    df = (views.subscribers(spark, d).join(views.viewing(spark, d), "custkey", "left")
          .join(views.support(spark, d), "custkey", "left"))
    months = F.col("tenure_months") + 12 * F.col("avg_daily_hours") / 3 * F.col("completion_rate")
    return df.select("subscriber_id", C.half_up(C.at_least(months, 1.0), 4).alias("months"),
                     C.half_up(C.at_least(1 - 0.1 * F.col("support_tickets"), 0.5), 4).alias("factor"))


@query("p9_equality_filter", "SELECT c_custkey AS custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'")
def p9(spark, d):
    return views.members(spark, d).filter(F.col("plan") == "trial").select("custkey")


@query("p10_membership_filter", """SELECT c_custkey AS custkey, c_mktsegment AS segment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'FURNITURE', 'AUTOMOBILE')""")
def p10(spark, d):
    return (views.members(spark, d).filter(F.col("plan").isin("basic", "standard"))
            .select("custkey", "segment"))


@query("p11_not_nan_filter", Q.with_views(Q.SUBSCRIBERS, Q.VIEWING) + f"""
SELECT s.subscriber_id, {rnd('total_value', 4)} AS prediction
FROM subscribers s JOIN viewing USING (custkey)""")
def p11(spark, d):
    v = views.viewing(spark, d).select("custkey", "total_value")
    df = views.members(spark, d).join(v, "custkey", "left").withColumn(
        "prediction", F.coalesce(F.col("total_value"), F.lit(float("nan"))))
    return df.filter(~F.isnan("prediction")).select(
        "subscriber_id", C.half_up(F.col("prediction"), 4).alias("prediction"))


@query("p12_substring_number", "SELECT c_custkey AS custkey, c_custkey AS user_id FROM customer")
def p12(spark, d):
    return views.members(spark, d).select(
        "custkey", C.member_number(F.col("subscriber_id")).alias("user_id"))


@query("p13_id_format", "SELECT c_custkey, printf('SUB%05d', c_custkey) AS subscriber_id FROM customer")
def p13(spark, d):
    return tables.table(spark, d, "customer").select(
        "c_custkey", C.member_id(F.col("c_custkey")).alias("subscriber_id"))


@query("p14_casts", """SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS key_double,
CAST(o_custkey AS INTEGER) AS cust_int, CAST(o_custkey AS VARCHAR) AS cust_text,
CAST(o_orderdate AS DATE) AS order_day, TRY_CAST(o_orderpriority AS INTEGER) AS dirty,
TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority FROM orders""")
def p14(spark, d):
    prio = F.col("o_orderpriority")
    return tables.table(spark, d, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("double").alias("key_double"),
        F.col("o_custkey").cast("int").alias("cust_int"),
        F.col("o_custkey").cast("string").alias("cust_text"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        prio.try_cast("int").alias("dirty"),
        F.substring(prio, 1, 1).try_cast("int").alias("priority"))


@query("p15_rounding", f"""SELECT l_orderkey, l_linenumber, l_partkey,
{rnd('l_extendedprice * (1 - l_discount)', 1)} AS net,
round_even(l_quantity / 2, 0) AS half_qty FROM lineitem""")
def p15(spark, d):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return tables.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", C.half_up(net, 1).alias("net"),
        C.half_even(F.col("l_quantity") / 2, 0).alias("half_qty"))


@query("p16_math", f"""SELECT o_orderkey, {rnd('abs(o_totalprice - 250000)', 2)} AS gap,
{rnd('sqrt(o_totalprice)', 4)} AS root, {rnd('1 / (1 + exp(-(o_totalprice - 250000) / 100000))', 6)} AS logistic,
{rnd('ln(o_totalprice / 1000000 / (1 - o_totalprice / 1000000))', 6)} AS log_odds,
{rnd('sin(o_totalprice / 100000)', 6)} AS sine FROM orders""")
def p16(spark, d):
    price = F.col("o_totalprice")
    return tables.table(spark, d, "orders").select(
        "o_orderkey", C.half_up(F.abs(price - 250000), 2).alias("gap"),
        C.half_up(F.sqrt(price), 4).alias("root"),
        C.half_up(C.logistic((price - 250000) / 100000), 6).alias("logistic"),
        C.half_up(C.log_odds(price / 1000000), 6).alias("log_odds"),
        C.half_up(F.sin(price / 100000), 6).alias("sine"))


@query("p18_threshold_label", Q.with_views(Q.SCORES) + """
SELECT custkey, CASE WHEN p_gbm >= 0.35 THEN 'Churn' ELSE 'Active' END AS prediction FROM scores""")
def p18(spark, d):
    return views.scores(spark, d).select(
        "custkey", C.threshold_label(F.col("p_gbm"), 0.35, "Churn", "Active").alias("prediction"))


@query("p19_date_stamp", Q.with_views(Q.SCORES) + """
SELECT custkey, p_rf, '2024-01-31' AS score_date FROM scores""")
def p19(spark, d):
    return stamp(views.scores(spark, d).select("custkey", "p_rf"), "2024-01-31")


def stamp(df, date: str | None = None):
    """Add the score date as text; today when none is given."""
    day = F.lit(date).cast("date") if date else F.current_date()
    return df.withColumn("score_date", day.cast("string"))


@query("p20_label_recode", Q.with_views(Q.CHURN) + """
SELECT "CustomerID", CASE "Churn" WHEN 0 THEN 'Active' WHEN 1 THEN 'Churn' END AS churn_name,
CAST(CASE "Churn" WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS label FROM churn""")
def p20(spark, d):
    named = views.churn(spark, d).select(
        "CustomerID", C.recode(F.col("Churn"), V.CLASS_NAMES).alias("churn_name"))
    return named.withColumn("label", F.when(F.col("churn_name") == "Churn", 1).otherwise(0))
