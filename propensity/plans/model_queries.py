"""Models: fit and score (M), and reading a probability from its vector (P17)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import balance, linear, sampling
from propensity.operators import boosting as B
from propensity.operators import forecast as T
from propensity.operators import models as M
from propensity.operators.features import assemble
from propensity.operators.penalised import penalty_paths
from propensity.operators.subscribers import plan_flags, value_columns
from propensity.plans import view_sql as Q
from propensity.plans.prepared import VALUE_COLUMNS, churn_data
from propensity.plans.registry import query, rnd
from propensity.session import keep
from propensity.sources import views


def _scored(model, rows):
    return M.score(model, rows).select("CustomerID", "label", "prob")


@query("p17_vector_element")
def p17(spark, d):
    data = churn_data(spark, d)
    out = M.fit("conversion_logistic", data.train).transform(data.rows)
    return out.select("CustomerID", C.class_probability(F.col("probability")).alias("prob"))


def _weighted(data, name):
    train = balance.add_class_weight(data.train, "label")
    return M.fit_families(train, "CustomerID", {name: {}}, weight="class_weight")[name, None]


@query("m1_logistic_regression")
def m1(spark, d):
    data = churn_data(spark, d)
    train = balance.add_class_weight(data.train, "label")
    return _scored(M.fit("churn_logistic", train, weight="class_weight"), data.rows)


@query("m2_forest_classifier")
def m2(spark, d):
    data = churn_data(spark, d)
    return _scored(M.fit("churn_forest", data.train), data.rows)


def loan_rows(spark, d):
    """Loan lines with dummies; a plain 70/30 split by order."""
    cols = ["l_quantity", "l_discount", "l_tax", "flag_a", "flag_n", "flag_r", "status_f", "status_o"]
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    df = views.loans(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "loan_amount", "l_quantity", "l_discount", "l_tax",
        C.flag(flag == "A").alias("flag_a"), C.flag(flag == "N").alias("flag_n"),
        C.flag(flag == "R").alias("flag_r"), C.flag(status == "F").alias("status_f"),
        C.flag(status == "O").alias("status_o"))
    df = assemble(df, cols).withColumn("label", F.col("loan_amount"))
    return sampling.random_split(df, "l_orderkey", [0.7, 0.3], 27)


@query("m3_forest_regressor")
def m3(spark, d):
    train, test = loan_rows(spark, d)
    model = M.fit("loan_forest", train)
    return model.transform(test).select("l_orderkey", "l_linenumber", "l_partkey",
                                        F.col("label").alias("actual"), "prediction")


LS_COLS = ["n_orders", "tenure_months", "recency_days"]


def _residual_steps(cols: list[str]) -> str:
    """Sequential residuals as SQL: each step removes one column from the later ones."""
    views_sql = ["x0 AS (SELECT custkey, " + ", ".join(
        f"CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER () AS c{i}" for i, c in enumerate(cols))
        + " FROM base)"]
    for i in range(len(cols) - 1):
        later = range(i + 1, len(cols))
        views_sql.append(f"g{i} AS (SELECT " + ", ".join(
            f"sum(c{i} * c{j}) / sum(c{i} * c{i}) AS g{j}" for j in later) + f" FROM x{i})")
        views_sql.append(f"x{i + 1} AS (SELECT custkey, " + ", ".join(
            f"c{j} - g{j} * c{i} AS c{j}" if j in later else f"c{j}" for j in range(len(cols)))
            + f" FROM x{i}, g{i})")
    return ", ".join(views_sql)


_LAST = f"x{len(LS_COLS) - 1}"


@query("m4_linear_regression", Q.with_views(
    Q.ORDER_FEATURES, "base AS (SELECT * FROM order_features WHERE n_orders > 0)",
    _residual_steps(LS_COLS), "f AS (SELECT custkey, avg(total_spend) OVER () AS m, " + ", ".join(
        f"{_LAST}.c{i}, covar_samp(total_spend, {_LAST}.c{i}) OVER () / var_samp({_LAST}.c{i}) OVER () AS b{i}"
        for i in range(len(LS_COLS))) + f" FROM base JOIN {_LAST} USING (custkey))") + f"""
SELECT custkey, {rnd('m + ' + ' + '.join(f'b{i} * c{i}' for i in range(len(LS_COLS))), 2)} AS prediction FROM f""")
def m4(spark, d):
    base = keep(views.order_features(spark, d).filter(F.col("n_orders") > 0))
    fit = linear.least_squares(base, "total_spend", LS_COLS)
    return fit.predict(base).select("custkey", C.half_up(F.col("prediction"), 2).alias("prediction"))


@query("m4_elastic_net_linear")
def m4b(spark, d):
    rows = value_rows(spark, d)
    model = M.fit("value_linear", rows.filter(F.col("split") == "train"))
    return model.transform(rows).select("subscriber_id", "label", "prediction")


def value_rows(spark, d):
    """All subscribers with assembled features; rows with a label are split 80/20, the others are only
    scored: split `new`."""
    df = value_columns(plan_flags(views.subscriber_features(spark, d)))
    df = sampling.with_split(df, "subscriber_id", {"train": 0.8, "test": 0.2}).fillna(0, VALUE_COLUMNS)
    df = df.withColumn("split", F.when(F.col("estimated_ltv_usd").isNotNull(), F.col("split")).otherwise("new"))
    return keep(assemble(df, VALUE_COLUMNS).select(
        "subscriber_id", F.col("estimated_ltv_usd").alias("label"), "features", "split"))


@query("m5_boosted_regressor")
def m5(spark, d):
    rows = value_rows(spark, d)
    model = M.fit("value_boosted", rows.filter(F.col("split") == "train"))
    return model.transform(rows).select("subscriber_id", "label", "prediction")


@query("m6_boosted_classifier")
def m6(spark, d):
    data = churn_data(spark, d)
    return _scored(_weighted(data, "boosted"), data.rows)


def _rounds(spark, d):
    """A booster of 500 rounds, fitted once, with its validation loss after every round."""
    data = churn_data(spark, d)
    model = M.fit_families(data.train, "CustomerID", {"xgb_like": {"rounds": 500}})["xgb_like", None]
    return data, model, B.loss_by_round(model, data.val).orderBy("rounds").collect()


@query("m7_best_rounds")
def m7(spark, d):
    _, _, losses = _rounds(spark, d)
    best = min(losses, key=lambda r: (r.loss, r.rounds)).rounds
    return spark.createDataFrame([(r.rounds, r.loss, r.rounds == best) for r in losses],
                                 "rounds int, loss double, is_best boolean")


@query("m7_scores_at_best_rounds")
def m7b(spark, d):
    """The chosen number of rounds goes into the model that scores."""
    data, model, losses = _rounds(spark, d)
    best = min(losses, key=lambda r: (r.loss, r.rounds)).rounds
    return _scored(model.first(best), data.rows).withColumn("rounds", F.lit(best))


@query("m8_xgb_like_booster")
def m8(spark, d):
    data = churn_data(spark, d)
    return _scored(_weighted(data, "xgb_like"), data.rows)


@query("m8_first_split", Q.with_views(Q.CHURN, """x AS (SELECT CAST(tenure AS DOUBLE) AS v, 0.5 - "Churn" AS g, 0.25 AS h FROM churn),
t AS (SELECT sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h, count(*) AS n FROM x),
c AS (SELECT DISTINCT v, sum(g) OVER w AS lg, sum(h) OVER w AS lh, count(*) OVER w AS ln FROM x WINDOW w AS (ORDER BY v RANGE UNBOUNDED PRECEDING)),
s AS (SELECT v, lg::DOUBLE AS lg, lh::DOUBLE AS lh, ln, g - lg::DOUBLE AS rg, h - lh::DOUBLE AS rh, n - ln AS rn,
 (lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1)) / 2.0::DOUBLE - 0.1 AS gain FROM c, t
 WHERE lh >= 5 AND h - lh >= 5)""") + f"""
SELECT v AS threshold, {rnd('gain', 4)} AS gain, ln AS n_left, rn AS n_right, {rnd('-lg / (lh + 1) * 0.05', 6)} AS left_value,
{rnd('-rg / (rh + 1) * 0.05', 6)} AS right_value FROM s WHERE s.gain > 1e-9 ORDER BY s.gain DESC, v LIMIT 1""")
def m8_first(spark, d):
    """The first split of the booster on one column, and its leaves."""
    rows = views.churn(spark, d).select("CustomerID", F.col("Churn").alias("label"), F.col("tenure").cast("double").alias("tenure"))
    data = B.bin_rows(assemble(rows, ["tenure"]), "CustomerID", bins=255)
    spec = replace(B.SPECS["xgb_like"], rounds=1, depth=1, row_share=1.0, columns=1.0)
    n = B.fit_trees(data, [B.Job(spec)])[0].nodes(spark, ["tenure"])
    root, left, right = (n.filter(F.col("node") == i) for i in range(3))
    return root.select("threshold", C.half_up(F.col("gain"), 4).alias("gain")).crossJoin(left.select(
        F.col("rows").cast("bigint").alias("n_left"), C.half_up(F.col("value"), 6).alias("left_value"))).crossJoin(right.select(
            F.col("rows").cast("bigint").alias("n_right"), C.half_up(F.col("value"), 6).alias("right_value")))


@query("m9_lgb_like_booster")
def m9(spark, d):
    data = churn_data(spark, d)
    return _scored(_weighted(data, "lgb_like"), data.rows)


@query("m10_lasso_path")
def m10(spark, d):
    return penalty_paths(B.bin_rows(churn_data(spark, d).train, "CustomerID"))[0].table(spark)


@query("m10_lasso_scores")
def m10b(spark, d):
    """Scores of the fit that carries the chosen penalty."""
    data = churn_data(spark, d)
    model = penalty_paths(B.bin_rows(data.train, "CustomerID"))[0].model()
    return _scored(model, data.rows).withColumn("lambda", F.lit(model.penalty))


@query("m11_decision_tree")
def m11(spark, d):
    data = churn_data(spark, d)
    return _scored(M.fit("tree", data.train), data.rows)


@query("m12_linear_svc")
def m12(spark, d):
    data = churn_data(spark, d)
    return _scored(M.fit("svc", data.train), data.rows)


@query("m13_naive_bayes")
def m13(spark, d):
    data = churn_data(spark, d)
    return _scored(M.fit("bayes", data.train), data.rows)


def rating_rows(spark, d):
    # the learner takes 32-bit ids: dense numbers would be needed beyond them, so an overflow has to fail
    return keep(views.ratings(spark, d).select(
        F.col("user_id").cast("int").alias("user_id"), F.col("item_id").cast("int").alias("item_id"),
        F.col("rating").cast("float").alias("rating")))


@query("m14_recommender_fit")
def m14(spark, d):
    rows = rating_rows(spark, d)
    return M.fit_recommender(rows).transform(rows)


@query("m15_top_items_per_user")
def m15(spark, d):
    return M.recommend(M.fit_recommender(rating_rows(spark, d)), 5)


@query("m16_score_any_model")
def m16(spark, d):
    data = churn_data(spark, d)
    models = M.fit_families(data.train, "CustomerID", {"tree": {}, "bayes": {}, "lasso": {}})
    parts = [M.score(model, data.rows).select(F.lit(name).alias("model"), "CustomerID", "prob") for (name, _), model in models.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


OUTLIER_COLS = ["login_failures", "payment_failures", "avg_daily_hours", "content_starts",
                "support_tickets"]


def outlier_sql(cols: list[str]) -> str:
    n = len(cols) - 1
    d2 = " + ".join(f"c{i} * c{i} / var_samp(c{i}) OVER ()" for i in range(n + 1))
    return Q.with_views(Q.FEATURES, "base AS (SELECT * FROM features)", _residual_steps(cols),
                        f"d AS (SELECT custkey, {d2} AS d2 FROM x{n})") + f"""
SELECT custkey, {rnd('d2', 4)} AS outlier_score,
CAST(d2 > (SELECT quantile_cont(d2, 0.95) FROM d) AS INTEGER) AS is_suspicious FROM d"""


@query("m17_outlier_distance", outlier_sql(OUTLIER_COLS))
def m17(spark, d):
    rows = keep(views.subscriber_features(spark, d).select("custkey", *OUTLIER_COLS))
    out = linear.flag_outliers(linear.mahalanobis(rows, OUTLIER_COLS), "outlier_score")
    return out.select("custkey", C.half_up(F.col("outlier_score"), 4).alias("outlier_score"),
                      "is_suspicious")


@query("m18_seasonal_order_search")
def m18(spark, d):
    return T.order_search(views.weekly_orders(spark, d)).select(
        "series", "p", "d", "q", "aic", "is_best")


@query("m19_forecast")
def m19(spark, d):
    return T.forecast(views.weekly_orders(spark, d), steps=12)
