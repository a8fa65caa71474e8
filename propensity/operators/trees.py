"""Forests as tables: nodes, edges, statistics, votes, proximity."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.session import keep, new_path


def names_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "feature_index int, feature string")


def node_table(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """One row per node of every tree, from the saved model files."""
    path = new_path(spark, "model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in saved.columns else F.struct(*saved.columns)
    tree = F.col("treeID") if "treeID" in saved.columns else F.lit(0)
    flat = saved.select(tree.alias("tree"), node.alias("n")).select(
        "tree", F.col("n.id").alias("node"), F.col("n.leftChild").alias("left"),
        F.col("n.rightChild").alias("right"), (F.col("n.leftChild") < 0).alias("is_leaf"),
        F.col("n.split.featureIndex").alias("feature_index"),
        F.get("n.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("n.gain").alias("gain"), F.col("n.impurity").alias("impurity"),
        F.col("n.rawCount").alias("rows"), F.col("n.prediction").alias("prediction"),
        F.col("n.impurityStats").alias("stats"))
    return flat.join(names_table(spark, names), "feature_index", "left").select(
        "tree", "node", "left", "right", "is_leaf", "feature", "threshold", "gain", "impurity",
        "rows", "prediction", "stats")


def tree_statistics(spark: SparkSession, model, nodes: DataFrame) -> DataFrame:
    """Depth, node and leaf counts of each tree."""
    trees = model.trees if hasattr(model, "trees") else [model]
    depths = spark.createDataFrame([(i, t.depth) for i, t in enumerate(trees)], "tree int, depth int")
    counts = nodes.groupBy("tree").agg(F.count("*").alias("nodes"),
                                       F.count_if("is_leaf").alias("leaves"))
    return counts.join(depths, "tree")


def tree_edges(nodes: DataFrame) -> DataFrame:
    """Parent to child, `yes` on the left, with a text for both ends."""
    text = F.when(F.col("is_leaf"), F.format_string("class %.0f", "prediction")).otherwise(
        F.format_string("%s <= %.4f", "feature", "threshold"))
    lookup = nodes.select("tree", F.col("node").alias("child"), text.alias("child_text"))
    ends = nodes.filter(~F.col("is_leaf")).select(
        "tree", F.col("node").alias("parent"), text.alias("parent_text"),
        F.explode(F.array(F.struct(F.col("left").alias("child"), F.lit("yes").alias("branch")),
                          F.struct(F.col("right").alias("child"), F.lit("no").alias("branch"))))
        .alias("e"))
    return ends.select("tree", "parent", "parent_text", F.col("e.child").alias("child"),
                       F.col("e.branch").alias("branch")).join(lookup, ["tree", "child"])


def leaf_predictions(nodes: DataFrame) -> Column:
    """array[tree][leaf] of predicted classes as a scalar; its size is that of the model.

    Leaves are numbered as the model numbers them, left to right.
    """
    leaves = nodes.filter("is_leaf").groupBy("tree").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("node", "prediction"))),
                    lambda x: x["prediction"]).alias("p"))
    return leaves.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "p"))),
                                  lambda x: x["p"]).alias("m")).scalar()


def leaves_of(model, df: DataFrame, out: str = "leaves") -> DataFrame:
    """Add the leaf number of each row in every tree as array<int>."""
    marked = model.copy()
    marked.setLeafCol("__leaf")
    drop = [c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns]
    return (marked.transform(df).withColumn(out, vector_to_array("__leaf").cast("array<int>"))
            .drop("__leaf", *drop))


def tree_votes(model, nodes: DataFrame, df: DataFrame, out: str = "votes") -> DataFrame:
    """Add array<double>: the class each tree gives the row. No shuffle."""
    placed = leaves_of(model, df, "__leaves").withColumn("__m", leaf_predictions(nodes))
    vote = F.transform("__leaves", lambda leaf, t: F.col("__m")[t][leaf])
    return placed.withColumn(out, vote).drop("__leaves", "__m")


def vote_share(voted: DataFrame, votes: str = "votes") -> DataFrame:
    total = F.aggregate(votes, F.lit(0.0), lambda s, v: s + v)
    return voted.withColumn("vote_share", total / F.size(votes))


def error_by_trees(voted: DataFrame, label: str, votes: str = "votes") -> DataFrame:
    """Error of the majority vote of the first 1..T trees; the first smallest is marked."""
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("sums"))
    sums = F.aggregate(votes, start, lambda s, v: F.struct(
        (s["sum"] + v).alias("sum"), F.concat(s["sums"], F.array(s["sum"] + v)).alias("sums")))
    each = voted.select(F.col(label).alias("y"), F.posexplode(sums["sums"]).alias("i", "s"))
    guess = (F.col("s") * 2 >= F.col("i") + 1).cast("int")
    curve = each.groupBy((F.col("i") + 1).alias("trees")).agg(
        F.avg((guess != F.col("y")).cast("double")).alias("error"))
    first = F.row_number().over(Window.partitionBy().orderBy("error", "trees")) == 1
    return curve.withColumn("is_best", first)


def representative_tree(voted: DataFrame, votes: str = "votes") -> DataFrame:
    """Mean disagreement of each tree with all trees; the smallest is marked.

    For 0/1 votes the mean over trees j of (v_i - v_j)^2 is v_i^2 - 2 v_i m + m, with m the
    row's mean vote, so no pairs of trees are formed.
    """
    shared = vote_share(voted, votes)
    each = shared.select("vote_share", F.posexplode(votes).alias("tree", "v"))
    gap = F.col("v") * F.col("v") - 2 * F.col("v") * F.col("vote_share") + F.col("vote_share")
    out = each.groupBy("tree").agg(F.avg(gap).alias("distance"))
    first = F.row_number().over(Window.partitionBy().orderBy("distance", "tree")) == 1
    return out.withColumn("is_representative", first)


def class_proximity(model, df: DataFrame, key: str, label: str) -> DataFrame:
    """Mean share of trees in which a row shares its leaf with the rows of each class.

    Rows are counted per (tree, leaf, class) on the map side. The counts have the size of
    the model and are looked up row by row: no pair of rows, and no shuffle of the rows.
    """
    placed = leaves_of(model, df.select(key, label, "features"))
    each = placed.select(label, F.posexplode("leaves").alias("tree", "leaf"))
    cells = each.groupBy("tree", "leaf").agg(
        F.array(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).alias("n"))
    # arrays indexed by tree and leaf, of the size of the model
    per_tree = cells.groupBy("tree").agg(F.map_from_entries(F.collect_list(F.struct("leaf", "n"))).alias("m"), F.max("leaf").alias("last"))
    dense = F.transform(F.sequence(F.lit(0).cast("int"), F.col("last").cast("int")), lambda i: F.element_at("m", i))
    table = per_tree.select("tree", dense.alias("n")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("tree", "n"))), lambda t: t["n"])).scalar()
    sizes = df.agg(F.array(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1))).scalar()
    shared = F.transform("leaves", lambda leaf, t: F.get(F.get("__m", t), leaf.cast("int")))

    def share(c: int) -> Column:
        total = F.aggregate("__near", F.lit(0).cast("bigint"), lambda s, x: s + x[c])
        return F.try_divide(total / F.size("leaves"), F.col("__size")[c])

    return (placed.withColumn("__m", table).withColumn("__size", sizes).withColumn("__near", shared)
            .select(key, label, share(0).alias("to_class0"), share(1).alias("to_class1")))


LANDMARKS = 256  # rows that span the map, at most


def leaf_map(model, df: DataFrame, key: str, landmarks: int = LANDMARKS) -> DataFrame:
    """Two principal coordinates of the proximity to a bounded set of landmark rows.

    The landmarks are the first rows of a key hash; their proximities (share of common leaves) give
    a small eigenproblem, and every row is placed by its proximities to them, row by row.
    """
    placed = keep(leaves_of(model, df.select(key, "features")).select(key, "leaves"))
    marks = np.array([r.leaves for r in placed.orderBy(C.key_hash(key), key).limit(landmarks).select("leaves").collect()])
    if not len(marks):
        return placed.select(key, F.lit(0.0).alias("dim1"), F.lit(0.0).alias("dim2"))
    near = (marks[:, None, :] == marks[None, :, :]).mean(axis=2)
    mean, whole = near.mean(axis=0), near.mean()
    values, vectors = np.linalg.eigh(near - mean[:, None] - mean[None, :] + whole)
    order = np.argsort(-values)[:2]
    root = np.sqrt(np.maximum(values[order], 1e-12))
    axes = vectors[:, order] * np.sign(vectors[np.abs(vectors[:, order]).argmax(axis=0), order]) / root

    @F.pandas_udf("dim1 double, dim2 double")
    def place(leaves: pd.Series) -> pd.DataFrame:
        k = np.array([(marks == x).mean(axis=1) for x in leaves]).reshape(-1, len(marks))
        at = (k - k.mean(axis=1, keepdims=True) - mean + whole) @ axes
        return pd.DataFrame({"dim1": at[:, 0], "dim2": at[:, 1] if at.shape[1] > 1 else 0.0})

    return placed.withColumn("at", place("leaves")).select(key, "at.dim1", "at.dim2")


def split_importance(nodes: DataFrame) -> DataFrame:
    """Gain, cover and frequency of each feature over the splits of a boosted model."""
    splits = nodes.filter(~F.col("is_leaf"))
    out = splits.groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"),
                                        F.sum("rows").alias("cover"), F.count("*").alias("frequency"))
    total = F.sum("gain").over(Window.partitionBy())
    return out.withColumn("relative_influence", 100 * F.try_divide(F.col("gain"), total))
