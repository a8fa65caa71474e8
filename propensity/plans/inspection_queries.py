"""Inspection (I) and error by trees (E11, E12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import boosting as B
from propensity.operators import explain as X
from propensity.operators import joins as J
from propensity.operators import models as M
from propensity.operators import outofbag as O
from propensity.operators import trees as R
from propensity.operators import treeshap as H
from propensity.plans import view_sql as Q
from propensity.plans.model_queries import value_rows
from propensity.plans.order_queries import u_sql
from propensity.plans.prepared import VALUE_COLUMNS, churn_data
from propensity.plans.registry import query


def _forest(spark, d):
    data = churn_data(spark, d)
    return data, M.fit("forest", data.train)


def _bagged(spark, d):
    """Training rows, and a forest whose bags are known row by row."""
    data = churn_data(spark, d)
    binned = B.bin_rows(data.train, "CustomerID")
    return data, binned, B.fit_trees(binned, [B.Job(B.SPECS["forest"])])[0]


@query("e11_error_by_trees")
def e11(spark, d):
    _, binned, model = _bagged(spark, d)
    return O.error_by_trees(binned, model)


@query("e12_vote_share")
def e12(spark, d):
    _, binned, model = _bagged(spark, d)
    return O.votes(binned, model)


@query("e12_bag_counts", Q.with_views(Q.CHURN, f"""train AS (SELECT * FROM churn WHERE {u_sql('"CustomerID"')} < 0.7)""")
       + O.bag_counts_sql("train", "CustomerID", B.SPECS["forest"]))
def e12_bags(spark, d):
    return O.bag_counts(B.bin_rows(churn_data(spark, d).train, "CustomerID"), B.SPECS["forest"])


@query("i1_forest_importance")
def i1(spark, d):
    data, model = _forest(spark, d)
    return X.importance(spark, model, data.names)


@query("i2_permutation_importance")
def i2(spark, d):
    data, binned, model = _bagged(spark, d)
    return O.permutation_importance(binned, model, data.names)


@query("i3_importance_spread")
def i3(spark, d):
    data, model = _forest(spark, d)
    names = data.names
    runs = [X.permutation_importance(model, data.test, "CustomerID", "label", names, seed)
            for seed in (1, 2, 3)]
    every = runs[0].unionByName(runs[1]).unionByName(runs[2])
    return every.groupBy("feature").agg(F.avg("importance").alias("mean"),
                                        F.stddev_samp("importance").alias("sd"))


@query("i4_coefficients")
def i4(spark, d):
    data = churn_data(spark, d)
    return X.coefficients(spark, M.fit_families(data.train, "CustomerID", {"lasso": {}})["lasso", None], data.names)


@query("i5_importance_comparison")
def i5(spark, d):
    data, model = _forest(spark, d)
    boosted = M.fit("boosted", data.train)
    forest = X.importance(spark, model, data.names).withColumnRenamed("importance", "forest_gini")
    mda = X.permutation_importance(model, data.test, "CustomerID", "label", data.names
                                   ).withColumnRenamed("importance", "forest_mda")
    gain = R.split_importance(R.node_table(spark, boosted, data.names)).select(
        "feature", F.col("gain").alias("boosted_gain"))
    return J.full_outer([forest, mda, gain], "feature").orderBy(
        F.desc_nulls_last("forest_mda"), "feature")


@query("i6_tree_nodes")
def i6(spark, d):
    data, model = _forest(spark, d)
    return R.node_table(spark, model, data.names).drop("stats")


@query("i7_tree_statistics")
def i7(spark, d):
    data, model = _forest(spark, d)
    return R.tree_statistics(spark, model, R.node_table(spark, model, data.names))


@query("i8_tree_edges")
def i8(spark, d):
    data, model = _forest(spark, d)
    return R.tree_edges(R.node_table(spark, model, data.names))


@query("i9_tree_text")
def i9(spark, d):
    _, model = _forest(spark, d)
    return spark.createDataFrame([(i, t.toDebugString) for i, t in enumerate(model.trees)], "tree int, text string")


@query("i10_vote_distribution")
def i10(spark, d):
    data, model = _forest(spark, d)
    out = model.transform(data.rows)
    return out.select("CustomerID", C.class_probability(F.col("rawPrediction"), 0).alias("votes_active"),
                      C.class_probability(F.col("rawPrediction"), 1).alias("votes_churn"))


def _decile_grid(data, name: str, points: int = 10) -> tuple[int, list[float]]:
    """Slot of a feature and its approximate quantiles over the training rows."""
    slot = data.names.index(name)
    col = data.encoder.transform(data.raw.filter(F.col("split") == "train")).select(name)
    return slot, sorted(set(col.approxQuantile(name, [(i + 0.5) / points for i in range(points)], 0.01)))


@query("i11_partial_dependence")
def i11(spark, d):
    data, model = _forest(spark, d)
    slot, values = _decile_grid(data, "tenure_imp")
    out = X.partial_dependence(model, data.train, {slot: values})
    return out.withColumnRenamed(f"value_{slot}", "tenure")


@query("i11_partial_dependence_pair")
def i11b(spark, d):
    data, model = _forest(spark, d)
    a, av = _decile_grid(data, "tenure_imp", 5)
    b, bv = _decile_grid(data, "MonthlyCharges_imp", 5)
    out = X.partial_dependence(model, data.train, {a: av, b: bv})
    return out.withColumnsRenamed({f"value_{a}": "tenure", f"value_{b}": "MonthlyCharges"})


@query("i12_class_proximity")
def i12(spark, d):
    data, model = _forest(spark, d)
    return R.class_proximity(model, data.rows, "CustomerID", "label")


@query("i13_leaf_map")
def i13(spark, d):
    data, model = _forest(spark, d)
    return R.leaf_map(model, data.rows, "CustomerID")


def _attributed(spark, d):
    data = churn_data(spark, d)
    model = M.fit_families(data.train, "CustomerID", {"xgb_like": {}})["xgb_like", None]
    return H.shapley_values(model, data.rows, "CustomerID", data.names)


@query("i14_shapley_values")
def i14(spark, d):
    """Exact values on the margin of the booster, for all rows."""
    return _attributed(spark, d)


@query("i14_mean_absolute_shapley")
def i14b(spark, d):
    return X.mean_absolute(_attributed(spark, d))


@query("i15_representative_tree")
def i15(spark, d):
    data, model = _forest(spark, d)
    nodes = R.node_table(spark, model, data.names)
    return R.representative_tree(R.tree_votes(model, nodes, data.rows))


@query("i16_regression_summary")
def i16(spark, d):
    rows = value_rows(spark, d).filter(F.col("split") != "new")
    model = M.fit("linear", rows, solver="normal")
    return X.regression_summary(spark, model, VALUE_COLUMNS)


@query("i17_boosting_importance")
def i17(spark, d):
    data = churn_data(spark, d)
    model = M.fit("boosted", data.train)
    return R.split_importance(R.node_table(spark, model, data.names))
