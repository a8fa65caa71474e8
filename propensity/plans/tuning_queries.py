"""Tuning (T) and records (L)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import boosting as B
from propensity.operators import ensemble as N
from propensity.operators import features as X
from propensity.operators import metrics as E
from propensity.operators import models as M
from propensity.operators import outofbag as O
from propensity.operators import pruning as P
from propensity.operators import records as L
from propensity.operators import sampling
from propensity.operators import tuning as T
from propensity.operators.penalised import penalty_paths
from propensity.plans import view_sql as Q
from propensity.plans.ensemble_queries import BASE
from propensity.plans.loan_job import train_loan_model
from propensity.plans.metric_queries import AUC_BY_MODEL
from propensity.plans.prepared import CHURN_FEATURES, churn_data
from propensity.plans.registry import query, rnd
from propensity.session import keep, new_path
from propensity.sources import tables, views

# ---- tuning --------------------------------------------------------------------------


# The published grids.
FOREST_GRID = {"trees": [100, 300, 500], "depths": [4, 6, 8], "min_rows": [5, 10], "shares": [0.7, 0.9]}
BOOSTER_GRID = {"rounds": [100, 300, 500], "depth": [3, 5, 7], "eta": [0.01, 0.05, 0.1], "gamma": [0.0, 0.1],
                "columns": [0.6, 0.8], "min_weight": [1.0, 5.0], "row_share": [0.7, 0.9]}
GBM_GRID = {"rounds": [200, 500], "depth": [3, 5], "eta": [0.01, 0.05], "min_rows": [10, 20]}


@query("t1_grid_search")
def t1(spark, d):
    return T.forest_grid(churn_data(spark, d).train, "CustomerID", **FOREST_GRID, folds=3)


@query("t2_train_validation_split")
def t2(spark, d):
    data = churn_data(spark, d)
    grid = T.combinations({"maxDepth": [3, 5], "minInstancesPerNode": [1, 10]})
    return T.split_search(data.train, "forest", grid)[1]


@query("t3_metrics_per_parameters")
def t3(spark, d):
    """All sixteen sets of the plain booster, five folds."""
    fixed = {"second_order": False, "from_mean": True}
    return T.booster_grid(churn_data(spark, d).train, "CustomerID", [{**c, **fixed} for c in T.combinations(GBM_GRID)], 5)


@query("t4_out_of_bag_grid")
def t4_oob(spark, d):
    """Eighteen forests judged by the rows that their trees did not see."""
    data = B.bin_rows(churn_data(spark, d).train, "CustomerID")
    fitted = [(c, m) for c in (3, 5, 7) for m in (1, 5, 10)]
    models = B.fit_trees(data, [B.Job(B.Spec(rounds=500, depth=8, min_rows=m, forest=True, columns=c)) for c, m in fitted])
    names = F.array(*[F.lit(f"featureSubset={c}, minInstancesPerNode={m}") for c, m in fitted])
    out = O.grid_errors(data, models, [300, 500]).select(F.get(names, "model").alias("params"), "trees", "error", "brier")
    best = F.row_number().over(Window.partitionBy().orderBy("brier", "params", "trees")) == 1  # a row per set
    return out.withColumn("is_best", best)


@query("t4_holdout_error_grid")
def t4(spark, d):
    data = churn_data(spark, d)
    grid = T.combinations({"numTrees": [300, 500], "featureSubsetStrategy": ["3", "5", "7"], "minInstancesPerNode": [1, 5, 10]})
    return T.brier_search(data.train, data.val, "forest", grid, "CustomerID")


@query("t5_stepwise_features_per_split")
def t5(spark, d):
    data = churn_data(spark, d)
    return T.stepwise_features_per_split(data.train, data.val, len(data.names))


@query("t6_random_grid")
def t6(spark, d):
    grid = [{**c, "l2": 1.0} for c in T.random_combinations(BOOSTER_GRID, 20)]
    return T.booster_grid(churn_data(spark, d).train, "CustomerID", grid, 5)


@query("t7_meta_alpha_search")
def t7(spark, d):
    """Every alpha has its own path of penalties over the five out-of-fold scores; all paths in step."""
    oof = N.out_of_fold(churn_data(spark, d).train, "CustomerID", BASE, 5).drop("features", "fold")
    data = B.bin_rows(X.assemble(oof, [f"prob_{n}" for n in BASE]), "CustomerID")
    alphas = [i / 10 for i in range(11)]
    paths = penalty_paths(data, folds=5, alphas=alphas)
    best = max(range(11), key=lambda i: (round(float(paths[i].auc.max()), 9), -i))
    rows = [(a, float(p.penalties[p.smallest]), float(p.auc[p.smallest]), i == best) for i, (a, p) in enumerate(zip(alphas, paths))]
    return spark.createDataFrame(rows, "alpha double, lambda double, auc double, is_best boolean").orderBy(F.desc("auc"), "alpha")


REGULARISED: dict[str, dict] = {n: {} for n in (
    "forest_regularised", "boosted_regularised", "logistic_regularised", "xgb_regularised", "lgb_regularised")}


@query("t8_regularised_presets")
def t8(spark, d):
    data = churn_data(spark, d)
    return T.leaderboard(data.train, data.test, REGULARISED, "CustomerID")


@query("t9_leaderboard")
def t9(spark, d):
    data = churn_data(spark, d)
    return T.leaderboard(data.train, data.test, {**BASE, "tree": {}, "bayes": {}, "svc": {}},
                         "CustomerID")


@query("t10_parameterised_job")
def t10(spark, d):
    return train_loan_model(spark, d, n_estimators=200, max_depth=5, min_samples_leaf=10,
                            min_samples_split=20)[1]


@query("t11_error_by_complexity")
def t11(spark, d):
    data = churn_data(spark, d)
    grid = T.combinations({"maxDepth": [1, 2, 3, 4, 6, 8], "minInfoGain": [0.0, 0.001, 0.01]})
    return T.grid_search(data.train, "tree", grid, 5, "CustomerID")[1]


def _costed(rows):
    """Rows weighted by what an error on them costs: a missed leaver counts three times."""
    return rows.withColumn("cost", F.when(F.col("label") == 1, 3.0).otherwise(1.0))


def _path(data):
    train = sampling.stratified_folds(_costed(data.train), "CustomerID", "label", 10)
    return P.pruning_path(B.bin_rows(train, "CustomerID", weight="cost", fold="fold"), 10)


@query("t11_pruning_path")
def t11b(spark, d):
    """Complexity, splits, error and cross-validated error of the nested subtrees."""
    return _path(churn_data(spark, d)).table(spark)


@query("m11_pruned_tree")
def m11b(spark, d):
    """Scores of the subtree with the smallest cross-validated error."""
    data = churn_data(spark, d)
    path = _path(data)
    return M.score(path.model(), data.rows).select("CustomerID", "label", "prob").withColumn("complexity", F.lit(path.smallest))


@query("t11_first_link", Q.with_views(Q.CHURN, """x AS (SELECT CAST(tenure AS DOUBLE) AS v, CASE WHEN "Churn" = 1 THEN 3 ELSE 0 END AS g,
 CASE WHEN "Churn" = 1 THEN 3 ELSE 1 END AS h FROM churn),
t AS (SELECT sum(g)::DOUBLE AS g, sum(h)::DOUBLE AS h, count(*) AS n FROM x),
c AS (SELECT DISTINCT v, sum(g) OVER w AS g, sum(h) OVER w AS h, count(*) OVER w AS n FROM x WINDOW w AS (ORDER BY v RANGE UNBOUNDED PRECEDING)),
s AS (SELECT v, c.g::DOUBLE AS lg, c.h::DOUBLE AS lh, t.g - c.g AS rg, t.h - c.h AS rh,
 (lg * lg / lh + rg * rg / nullif(rh, 0) - t.g * t.g / t.h) / 2 AS gain FROM c, t WHERE c.n >= 10 AND t.n - c.n >= 10),
b AS (SELECT * FROM s WHERE gain > 1e-9 ORDER BY gain DESC, v LIMIT 1),
r AS (SELECT least(t.g, t.h - t.g) AS root, coalesce(least(lg, lh - lg) + least(rg, rh - rg), least(t.g, t.h - t.g)) AS leaves
 FROM t LEFT JOIN b ON TRUE)""")
       + f" SELECT CASE WHEN root > leaves THEN 1 ELSE 0 END AS links, {rnd('(root - leaves) / root', 6)} AS price FROM r")
def t11c(spark, d):
    """The only link of a tree with one split: the price at which it goes; no link where the split saves nothing."""
    rows = views.churn(spark, d).select("CustomerID", F.col("Churn").alias("label"), F.col("tenure").cast("double").alias("tenure"))
    data = B.bin_rows(X.assemble(_costed(rows), ["tenure"]), "CustomerID", bins=255, weight="cost")
    links = P.weakest_links(B.fit_trees(data, [B.Job(replace(P.TREE, depth=1))])[0].trees[0])
    return spark.createDataFrame([(len(links) - 1, links[-1][0])], "links int, price double").withColumn(
        "price", C.half_up(F.col("price"), 6))


@query("f12_feature_elimination")
def f12(spark, d):
    data = churn_data(spark, d)
    return T.eliminate_features(data.train, data.names, [5, 10, 15, 20], "CustomerID", 5)


# ---- records -------------------------------------------------------------------------

@query("l1_save_and_load", Q.with_views(Q.CHURN) + 'SELECT "CustomerID", TRUE AS same FROM churn')
def l1(spark, d):
    data = churn_data(spark, d)
    model = M.fit("churn_logistic", data.train)
    path = L.save_model(spark, PipelineModel([*data.encoder.stages, model]))
    again = PipelineModel.load(path)
    now = M.score(model, data.rows).select("CustomerID", "prob")
    back = M.score(again, data.raw, "prob_loaded").select("CustomerID", "prob_loaded")
    return now.join(back, "CustomerID").select(
        "CustomerID", (F.col("prob") == F.col("prob_loaded")).alias("same"))


@query("l2_model_bundle")
def l2(spark, d):
    data = churn_data(spark, d)
    model = M.fit("tree", data.train)
    best = E.best_threshold(E.threshold_sweep(M.score(model, data.val), "label", "prob",
                                              E.grid(10, 90, 5))).first()
    threshold = (best["pct"] if best and best["pct"] is not None else 50) / 100
    path = L.save_bundle(spark, {"churn": PipelineModel([*data.encoder.stages, model])},
                         {"version": "v1.0", "threshold": threshold,
                          "features": ",".join(CHURN_FEATURES.numeric + CHURN_FEATURES.categorical)},
                         X.medians(data.raw.filter(F.col("split") == "train"), ["tenure", "TotalCharges"]))
    models, details = L.load_bundle(spark, path)
    scored = M.score(models["churn"], data.raw.filter(F.col("split") == "test"))
    return scored.select("CustomerID", "prob", C.threshold_label(
        F.col("prob"), float(details["threshold"]), "Churn", "Active").alias("prediction"))


def _runs(spark, d):
    """One run per written score: parameters, AUC, F1, a tag."""
    table = E.score_table(views.long_scores(spark, d), "label", "p", 0.4, ["model"])
    return table.select("model", F.lit("0.4").alias("threshold"), C.half_up(F.col("auc"), 6).alias("auc"),
                        C.half_up(F.col("f1"), 6).alias("f1"), F.lit("v3").alias("feature_set"))


_RUNS = """cells AS (SELECT model, count(*) FILTER (label = 1 AND p >= 0.4) AS tp,
count(*) FILTER (label = 0 AND p >= 0.4) AS fp, count(*) FILTER (label = 1 AND p < 0.4) AS fn FROM long_scores GROUP BY 1),
runs AS (SELECT model, """ + rnd("auc", 6) + " AS auc, " + rnd("2.0 * tp / (2 * tp + fp + fn)", 6) + """ AS f1
FROM aucs JOIN cells USING (model))"""


def _log(spark, d):
    rows = L.log_values(_runs(spark, d), "model", ["threshold"], ["auc", "f1"], ["feature_set"])
    return tables.load_dataset(spark, L.append_log(rows, new_path(spark, "runs")))


@query("l3_run_log", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL, _RUNS) + """
SELECT model AS run_id, 'param' AS kind, 'threshold' AS key, NULL::DOUBLE AS number, '0.4' AS text FROM runs
UNION ALL SELECT model, 'metric', 'auc', auc, NULL FROM runs UNION ALL SELECT model, 'metric', 'f1', f1, NULL FROM runs
UNION ALL SELECT model, 'tag', 'feature_set', NULL, 'v3' FROM runs""")
def l3(spark, d):
    metric = F.col("kind") == "metric"
    return _log(spark, d).select("run_id", "kind", "key",
                                 F.when(metric, F.col("value").try_cast("double")).alias("number"),
                                 F.when(~metric, F.col("value")).alias("text"))


@query("l4_search_runs", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL, _RUNS) + """
SELECT model AS run_id, auc, f1, '0.4' AS threshold FROM runs WHERE auc > 0.45 ORDER BY auc DESC, model LIMIT 10""")
def l4(spark, d):
    out = L.search_runs(_log(spark, d), "auc", 0.45, {
        "auc": "metric.auc", "f1": "metric.f1", "threshold": "param.threshold"})
    return out.withColumns({"auc": F.col("auc").cast("double"), "f1": F.col("f1").cast("double")})


@query("l5_model_register", Q.with_views(Q.LONG_SCORES, AUC_BY_MODEL) + """
SELECT model AS name, v AS version, CASE WHEN v = 1 THEN 'Archived'
WHEN auc >= (SELECT avg(auc) FROM aucs) THEN 'Production' ELSE 'Staging' END AS stage FROM aucs, (VALUES (1), (2)) t(v)""")
def l5(spark, d):
    aucs = keep(E.auc_roc(views.long_scores(spark, d), "label", "p", ["model"]))
    good = F.col("auc") >= aucs.agg(F.avg("auc")).scalar()
    path = new_path(spark, "register")
    steps = F.array(*[F.struct(F.lit(v).alias("version"), s.alias("stage"), F.lit(q).alias("seq"))
                      for v, s, q in ((1, F.lit("Staging"), 1), (1, F.lit("Production"), 2),
                                      (2, F.lit("Staging"), 3), (1, F.lit("Archived"), 4),
                                      (2, F.when(good, "Production").otherwise("Staging"), 5))])
    aucs.select(F.col("model").alias("name"), F.inline(steps)).write.mode("append").parquet(path)
    return L.current_stages(tables.load_dataset(spark, path, schema=L.REGISTER_SCHEMA))
