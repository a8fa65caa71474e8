"""The derived views as SQL, for the comparison queries."""

from __future__ import annotations

from propensity.plans.registry import rnd
from propensity.sources.views import MODELS, SCORE_FORMULAS

CUTOFF = """cut AS (SELECT max(CAST(o_orderdate AS DATE)) - 365 AS cutoff FROM orders)"""

ORDER_FEATURES = CUTOFF + """,
order_features AS (
  SELECT custkey, n_orders, total_spend, last_priority,
         total_spend / n_orders / 10000 AS monthly_fee_usd,
         CAST(floor((cutoff - first_day) / 30.0) AS INTEGER) AS tenure_months,
         CAST(cutoff - last_day AS INTEGER) AS recency_days,
         CAST(last_day_any <= cutoff AS INTEGER) AS churned
  FROM (
    SELECT o_custkey AS custkey, cutoff,
           min(d) FILTER (d <= cutoff) AS first_day,
           max(d) FILTER (d <= cutoff) AS last_day,
           max(d) AS last_day_any,
           CAST(count(*) FILTER (d <= cutoff) AS BIGINT) AS n_orders,
           sum(o_totalprice) FILTER (d <= cutoff) AS total_spend,
           arg_max(o_orderpriority, (d, substr(o_orderpriority, 1, 1))) FILTER (d <= cutoff) AS last_priority
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders), cut
    GROUP BY o_custkey, cutoff))"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS custkey, printf('SUB%05d', c_custkey) AS subscriber_id,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'trial' WHEN 'BUILDING' THEN 'basic'
              WHEN 'FURNITURE' THEN 'standard' WHEN 'AUTOMOBILE' THEN 'standard'
              WHEN 'MACHINERY' THEN 'premium' END AS plan,
         c_mktsegment AS segment, c_acctbal AS balance, n_name AS country, r_name AS region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey)"""

SUBSCRIBERS = ORDER_FEATURES + ", " + CUSTOMERS + """,
subscribers AS (SELECT c.*, o.n_orders, o.total_spend, o.last_priority, o.monthly_fee_usd,
                       o.tenure_months, o.recency_days
                FROM customers c LEFT JOIN order_features o USING (custkey))"""

ACTIVITY = """activity AS (
  SELECT user_id AS custkey, count(DISTINCT CAST(ts AS DATE)) AS days_active,
         sum(value) AS total_value,
         count(*) FILTER (event_type = 'view') AS content_starts,
         count(*) FILTER (event_type = 'purchase') AS n_purchase,
         count(*) FILTER (event_type = 'click') AS n_click,
         count(*) FILTER (event_type = 'error') AS support_tickets,
         count(*) FILTER (event_type = 'error' AND value > 50) AS payment_failures,
         count(*) FILTER (event_type = 'error' AND value <= 5) AS login_failures,
         count(*) FILTER (event_type = 'signup') % 4 AS plan_changes
  FROM events GROUP BY user_id)"""

VIEWING = ACTIVITY + """,
viewing AS (
  SELECT custkey, total_value / days_active / 24 AS avg_daily_hours, days_active, content_starts,
         n_purchase / (n_click + 1) AS completion_rate, total_value,
         ['smart_tv', 'mobile', 'tablet', 'web'][custkey % 4 + 1] AS device_type
  FROM activity),
support AS (SELECT custkey, support_tickets, payment_failures, login_failures, plan_changes
            FROM activity)"""

FEATURES = SUBSCRIBERS + ", " + VIEWING + """,
features AS (
  SELECT s.custkey, s.subscriber_id, s.plan, s.country, s.region, s.balance, s.n_orders,
         s.total_spend, s.monthly_fee_usd, s.tenure_months, s.recency_days, v.device_type,
         coalesce(v.avg_daily_hours, 0) AS avg_daily_hours,
         coalesce(v.completion_rate, 0) AS completion_rate,
         coalesce(v.days_active, 0) AS days_active,
         coalesce(v.content_starts, 0) AS content_starts,
         coalesce(p.support_tickets, 0) AS support_tickets,
         coalesce(p.payment_failures, 0) AS payment_failures,
         coalesce(p.login_failures, 0) AS login_failures,
         coalesce(p.plan_changes, 0) AS plan_changes, o.churned
  FROM subscribers s LEFT JOIN viewing v USING (custkey) LEFT JOIN support p USING (custkey)
       LEFT JOIN order_features o USING (custkey))"""

CHURN = ORDER_FEATURES + ", " + CUSTOMERS + """,
churn AS (
  SELECT c.custkey AS "CustomerID", o.tenure_months AS tenure,
         o.monthly_fee_usd * 3 AS "MonthlyCharges", e.v AS "TotalCharges",
         c.segment AS "Contract", c.region AS "InternetService",
         o.last_priority AS "PaymentMethod", o.churned AS "Churn"
  FROM customers c JOIN order_features o USING (custkey)
       LEFT JOIN (SELECT user_id AS custkey, sum(value) AS v FROM events GROUP BY 1) e USING (custkey)
  WHERE o.n_orders > 0)"""

RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         1 + (avg(l_quantity) - 1) / 49 * 4 AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

WEEKLY = """weekly_all AS (
  SELECT o_orderpriority AS series, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
         count(*) AS y FROM orders GROUP BY 1, 2),
weekly AS (SELECT * FROM weekly_all
           WHERE week >= (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)
             AND week + 6 <= (SELECT CAST(max(o_orderdate) AS DATE) FROM orders))"""


def _score(name: str) -> str:
    b0, b1, b2, b3, b4 = SCORE_FORMULAS[name]
    z = (f"{b0} + {b1} * (recency_days / 365.0) + {b2} * (n_orders / 10.0)"
         f" + {b3} * (monthly_fee_usd / 25.0) + {b4} * (tenure_months / 60.0)")
    return rnd(f"1.0 / (1.0 + exp(-({z})))", 4) + f" AS p_{name}"


SCORES = ORDER_FEATURES + ", " + CUSTOMERS + """,
scores AS (SELECT o.custkey, c.subscriber_id, c.plan, o.churned AS label, """ + ", ".join(
    _score(m) for m in MODELS) + """
           FROM order_features o JOIN customers c USING (custkey) WHERE n_orders > 0)"""

LONG_SCORES = SCORES + """,
long_scores AS (""" + " UNION ALL ".join(
    f"SELECT custkey, label, '{m}' AS model, p_{m} AS p FROM scores" for m in MODELS) + ")"


def with_views(*views: str) -> str:
    return "WITH " + ", ".join(views) + " "
