import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from propensity.operators import boosting as B
from propensity.operators import ensemble as N
from propensity.operators import explain as X
from propensity.operators import metrics as E
from propensity.operators import models as M
from propensity.operators import records as L
from propensity.operators import trees as R
from propensity.operators import tuning as T
from propensity.operators.features import FeatureSet, assemble, feature_names
from propensity.operators.sampling import stratified_folds
from propensity.session import keep

NAMES = ["noise", "signal", "weak"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        s, w = rng.random(), rng.random()
        rows.append((i, int(s + 0.3 * w + 0.1 * rng.random() > 0.75), rng.random(), s, w))
    df = spark.createDataFrame(rows, "id int, label int, noise double, signal double, weak double")
    return keep(assemble(df, NAMES))


@pytest.fixture(scope="module")
def forest(data):
    return M.fit("forest", data, numTrees=9, maxDepth=4)


@pytest.fixture(scope="module")
def nodes(spark, forest):
    return R.node_table(spark, forest, NAMES).cache()


@pytest.mark.parametrize("name", ["churn_logistic", "forest", "tree", "svc", "bayes", "lasso"])
def test_probabilities_and_auc(data, name):
    small = {"numTrees": 9} if name == "forest" else {}
    s = M.score(M.fit(name, data, **small), data)
    assert s.filter("prob < 0 OR prob > 1 OR prob IS NULL").count() == 0
    assert E.auc_roc(s, "label", "prob").first().auc > 0.85


def test_every_preset_builds():
    for name, (_, params) in M.PRESETS.items():
        est = M.estimator(name)
        assert all(est.getOrDefault(est.getParam(k)) == v for k, v in params.items())


def test_importance_ranks_the_planted_signal_first(spark, forest, data):
    assert X.importance(spark, forest, NAMES).first().feature == "signal"
    drops = {r.feature: r.importance for r in X.permutation_importance(
        forest, data, "id", "label", NAMES).collect()}
    assert max(drops, key=drops.get) == "signal" and drops["signal"] > 0.2
    assert abs(drops["noise"]) < 0.05


def test_partner_rows_are_a_permutation(spark):
    df = spark.range(500).withColumn("__x", F.array("id"))
    out = X._with_partner(df, "id", 3).select("id", F.col("__other")[0].alias("o")).collect()
    assert sorted(r.o for r in out) == list(range(500))
    assert all(r.o != r.id for r in out)


def test_node_table_agrees_with_the_model(spark, forest, nodes):
    stats = {r.tree: r for r in R.tree_statistics(spark, forest, nodes).collect()}
    for i, t in enumerate(forest.trees):
        assert (stats[i].depth, stats[i].nodes, stats[i].leaves) == (
            t.depth, t.numNodes, (t.numNodes + 1) // 2)
    edges = R.tree_edges(nodes)
    assert edges.count() == nodes.count() - len(forest.trees)
    assert edges.filter("parent_text IS NULL OR child_text IS NULL").count() == 0


def test_votes_agree_with_single_trees(forest, nodes, data):
    votes = {r.id: r.votes for r in R.tree_votes(forest, nodes, data).collect()}
    for i in (0, 4, 8):
        want = {r.id: r.prediction for r in forest.trees[i].transform(data).collect()}
        assert all(votes[k][i] == want[k] for k in want)


def test_error_curve_and_representative_tree(forest, nodes, data):
    voted = keep(R.tree_votes(forest, nodes, data))
    rows = voted.select("label", "votes").collect()
    curve = {r.trees: r.error for r in R.error_by_trees(voted, "label").collect()}
    assert len(curve) == 9
    for k in (1, 5, 9):
        wrong = sum(int(2 * sum(r.votes[:k]) >= k) != r.label for r in rows)
        assert curve[k] == pytest.approx(wrong / len(rows))
    dist = {r.tree: r.distance for r in R.representative_tree(voted).collect()}
    for i in range(9):
        want = sum((r.votes[i] - v) ** 2 for r in rows for v in r.votes) / len(rows) / 9
        assert dist[i] == pytest.approx(want)


def test_class_proximity_is_the_mean_of_pairs(forest, data):
    small = data.filter("id < 40")
    leaves = {r.id: r.leaves for r in R.leaves_of(forest, small).collect()}
    y = {r.id: r.label for r in small.collect()}
    near = lambda i, j: sum(a == b for a, b in zip(leaves[i], leaves[j])) / len(leaves[i])
    for r in R.class_proximity(forest, small, "id", "label").collect():
        want = sum(near(r.id, j) for j in y if y[j] == 1) / sum(y.values())
        assert r.to_class1 == pytest.approx(want)


def test_leaf_map(forest, data):
    assert R.leaf_map(forest, data, "id").count() == 600


def test_shapley_values_sum_to_the_prediction(forest, data):
    vals = X.shapley_values(forest, data, "id", NAMES, 4)
    total = {r.id: r.s for r in vals.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    scored = {r.id: r.prob for r in M.score(forest, data).select("id", "prob").collect()}
    base = {round(scored[i] - total[i], 9) for i in scored}
    assert len(base) == 1
    assert X.mean_absolute(vals).first().feature == "signal"


def test_partial_dependence_rises_with_the_signal(forest, data):
    out = X.partial_dependence(forest, data, {1: [0.1, 0.5, 0.9]}).orderBy("value_1").collect()
    assert out[0].mean_prob < out[1].mean_prob < out[2].mean_prob
    assert X.partial_dependence(forest, data, {1: [0.1, 0.9], 2: [0.2, 0.8]}).count() == 4


def test_split_importance(spark, data):
    model = M.fit("boosted", data, maxIter=3)
    out = R.split_importance(R.node_table(spark, model, NAMES)).orderBy(F.desc("gain"))
    assert out.first().feature == "signal"
    assert out.agg(F.sum("relative_influence")).first()[0] == pytest.approx(100)


def test_out_of_fold_scores_each_row_once(data):
    oof = N.out_of_fold(data, "id", {"tree": {}, "lasso": {}}, 3)
    assert oof.count() == 600 and oof.select("id").distinct().count() == 600
    assert oof.filter("prob_tree IS NULL OR prob_lasso IS NULL").count() == 0


def test_stack_and_blend(data):
    train, test = data.filter("id % 4 <> 0"), data.filter("id % 4 = 0")
    specs = {"tree": {}, "lasso": {}}
    for stack, name in ((N.fit_stack(train, "id", specs, 3), "prob_stack"),
                        (N.fit_blend(train.filter("id % 4 = 1"), train.filter("id % 4 > 1"), "id", specs), "prob_stack")):
        s = stack.score(test)
        assert s.count() == 150
        assert E.auc_roc(s, "label", name).first().auc > 0.85


def test_loss_by_round(data):
    model = M.fit_families(data, "id", {"xgb_like": {"rounds": 6}})["xgb_like", None]
    losses = [r.loss for r in B.loss_by_round(model, data).orderBy("rounds").collect()]
    assert len(losses) == 6 and losses == sorted(losses, reverse=True)
    p = {r.id: (r.label, r.prob) for r in model.first(2).score(data).collect()}
    want = sum(-math.log(q if y else 1 - q) for y, q in p.values()) / len(p)
    assert losses[1] == pytest.approx(want)


def test_bundle_keeps_every_kind(spark, data):
    models = M.fit_families(data, "id", {"xgb_like": {"rounds": 3}, "lasso": {}})
    named = {n: m for (n, _), m in models.items()}
    again, _ = L.load_bundle(spark, L.save_bundle(spark, named, {"x": 1}))
    for n, m in named.items():
        a, b = ({r.id: r.prob for r in M.score(x, data).collect()} for x in (m, again[n]))
        assert a == pytest.approx(b)


def test_grid_search_tables(data):
    model, table = T.grid_search(data, "tree", T.combinations({"maxDepth": [1, 4]}), 3, "id")
    rows = table.collect()
    assert len(rows) == 2 and rows[0].is_best and rows[0].metric >= rows[1].metric
    assert len(T.random_combinations({"a": [1, 2, 3], "b": [1, 2]}, 4)) == 4
    out = T.brier_search(data, data, "tree", T.combinations({"maxDepth": [1, 4]}))
    assert out.filter("is_best").count() == 1


def test_stepwise_and_elimination(data):
    out = T.stepwise_features_per_split(data, data, 3, numTrees=5, maxDepth=3)
    assert out.filter("is_best").count() == 1
    rfe = T.eliminate_features(data, NAMES, [2, 1], "id", 3, B.Spec(rounds=9, depth=3, forest=True, columns=3))
    rows = {r.size: r for r in rfe.collect()}
    assert set(rows) == {3, 2, 1} and rows[1].features == "signal" and sum(r.is_best for r in rows.values()) == 1


def test_shared_grids(data):
    """A grid's figure is the mean over the folds of the area of models fitted one by one."""
    table = T.booster_grid(data, "id", [{"rounds": 3, "depth": 2}, {"rounds": 1, "depth": 2}, {"rounds": 3, "depth": 1}], 3)
    got = {r.params: r.metric for r in table.collect()}
    rows = keep(stratified_folds(data, "id", "label", 3))
    each = []
    for f in range(3):
        model = B.fit_trees(B.bin_rows(rows.filter(F.col("fold") != f), "id"), [B.Job(B.Spec(rounds=3, depth=2))])[0]
        each.append(E.auc_roc(model.score(rows.filter(F.col("fold") == f)), "label", "prob").first().auc)
    assert got["rounds=3, depth=2"] == pytest.approx(sum(each) / 3, abs=0.02)  # quantile cuts differ a little
    forest = T.forest_grid(data, "id", [2, 5], [1, 3], [3], [0.8], 3).collect()
    assert len(forest) == 4 and forest[0].is_best and forest[0].metric >= forest[-1].metric > 0.5


def test_bundle_round_trip(spark, data):
    model = M.fit("tree", data)
    path = L.save_bundle(spark, {"m": PipelineModel([model])}, {"threshold": 0.35, "version": "v1"})
    models, details = L.load_bundle(spark, path)
    assert (details["threshold"], details["version"]) == ("0.35", "v1")
    a = M.score(model, data).select("id", "prob")
    b = M.score(models["m"], data).select("id", F.col("prob").alias("q"))
    assert a.join(b, "id").filter("prob <> q").count() == 0


def test_register_and_runs(spark):
    reg = spark.createDataFrame([("m", 1, "Staging", 1), ("m", 1, "Production", 2), ("m", 2, "Staging", 3)],
                                L.REGISTER_SCHEMA)
    assert {(r.version, r.stage) for r in L.current_stages(reg).collect()} == {(1, "Production"), (2, "Staging")}
    assert L.production_version(reg).first().version == 1
    wide = spark.createDataFrame([("r1", 0.9, "5"), ("r2", 0.8, "7")], "run string, auc double, depth string")
    log = L.log_values(wide, "run", ["depth"], ["auc"], [])
    assert log.count() == 4
    got = L.search_runs(log, "auc", 0.85, {"auc": "metric.auc", "depth": "param.depth"}).collect()
    assert [(r.run_id, r.depth) for r in got] == [("r1", "5")]


def test_feature_set_handles_unseen_and_missing(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "a")], "x double, c string")
    new = spark.createDataFrame([(None, "z")], "x double, c string")
    model = FeatureSet(("x",), ("c",)).fit(train)
    out = model.transform(new)
    assert feature_names(out)[0] == "x_imp"
    assert len(out.first().features) == len(feature_names(out)) == 3


def test_recommendations(spark):
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(9) if (u * i) % 4]
    model = M.fit_recommender(spark.createDataFrame(rows, "user_id int, item_id int, rating float"))
    recs = M.recommend(model, 5)
    assert recs.groupBy("user_id").count().filter("count <> 5").count() == 0
    assert {r.rank for r in recs.collect()} == {1, 2, 3, 4, 5}


def test_recommendations_are_the_exact_best(spark, monkeypatch):
    """All user-item products next to the blocks, with several blocks, a user of zeros and equal items."""
    rng = np.random.default_rng(3)
    u, v = rng.normal(size=(300, 4)).astype(np.float32), rng.normal(size=(200, 4)).astype(np.float32)
    u[7], v[20] = 0, v[30]
    frame = lambda x: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, features array<float>").repartition(3)

    class Model:
        userFactors, itemFactors, rank = frame(u), frame(v), 4
        getUserCol, getItemCol = staticmethod(lambda: "user_id"), staticmethod(lambda: "item_id")

    monkeypatch.setattr(M, "LONGEST", 16)
    monkeypatch.setattr(M, "SCORED", 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        got = {(r.user_id, r["rank"]): (r.item_id, r.rating) for r in M.recommend(Model, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 1500
    s = u @ v.T
    for i in range(300):
        order = np.lexsort((-np.arange(200), -s[i]))[:5]
        np.testing.assert_allclose([got[i, k][1] for k in range(1, 6)], s[i, order], rtol=1e-4, atol=1e-6)
        for k, item in enumerate(order, 1):
            assert got[i, k][0] == item or abs(s[i, got[i, k][0]] - s[i, item]) < 1e-4


def test_recommendations_score_only_blocks_that_can_reach(spark):
    """The plan joins blocks under a bound instead of all users with all items."""
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(9) if (u * i) % 4]
    model = M.fit_recommender(spark.createDataFrame(rows, "user_id int, item_id int, rating float"))
    plan = M.recommend(model, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "least" in plan and "<= top" in plan and "collect_top_k" not in plan


def test_recommendations_are_those_of_the_learner(spark):
    """To the last digit of the rating."""
    rows = [(u, i, float(1 + (3 * u + i * i) % 5)) for u in range(40) for i in range(30) if (u * i) % 3]
    model = M.fit_recommender(spark.createDataFrame(rows, "user_id int, item_id int, rating float"), maxIter=2)
    want = {(r.user_id, x.item_id, x.rating) for r in model.recommendForAllUsers(5).collect() for x in r.recommendations}
    assert {(r.user_id, r.item_id, r.rating) for r in M.recommend(model, 5).collect()} == want
