"""Model families with named parameter sets, fitting and scoring.

Frames carry `features` (vector) and `label`; scored frames get `prob` or `prediction`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.operators import boosting as B
from propensity.operators.boosting import TreeModel
from propensity.operators.penalised import LinearScore, penalty_paths
from propensity.session import keep

LONGEST = 4096  # item factors that give each user a first bound
ROUNDING = 4e-6  # of a product of 32-bit factors, by their lengths, with room
BLOCK_RATINGS = 1_000_000  # of a block of the learner, on the mean
SCORED = 1024  # users whose ratings of a block of items a task holds at a time

FAMILIES = {
    "logistic": LogisticRegression,
    "forest": RandomForestClassifier,
    "boosted": GBTClassifier,
    "tree": DecisionTreeClassifier,
    "svc": LinearSVC,
    "bayes": NaiveBayes,
    "linear": LinearRegression,
    "forest_regression": RandomForestRegressor,
    "boosted_regression": GBTRegressor,
}

# Parameter sets by name (family, parameters).
PRESETS: dict[str, tuple[str, dict]] = {
    "churn_logistic": ("logistic", {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}),
    "churn_forest": ("forest", {"numTrees": 100, "maxDepth": 8, "seed": 42}),
    "value_linear": ("linear", {"regParam": 0.01, "elasticNetParam": 0.3}),
    "value_boosted": ("boosted_regression", {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42}),
    "conversion_logistic": ("logistic", {"maxIter": 100}),
    "upsell_logistic": ("logistic", {"maxIter": 100, "regParam": 0.01}),
    "forest": ("forest", {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 5,
                          "featureSubsetStrategy": "sqrt", "subsamplingRate": 0.8, "seed": 42}),
    "boosted": ("boosted", {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8,
                            "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 10, "seed": 42}),
    "xgb_like": ("boosted", {"maxIter": 200, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.8,
                             "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "seed": 42}),
    "lgb_like": ("boosted", {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
                             "featureSubsetStrategy": "0.8", "minInstancesPerNode": 20, "seed": 42}),
    "lasso": ("logistic", {"maxIter": 100, "regParam": 0.005, "elasticNetParam": 1.0}),
    "meta_lasso": ("logistic", {"maxIter": 100, "regParam": 0.001, "elasticNetParam": 1.0}),
    "tree": ("tree", {"maxDepth": 4, "minInstancesPerNode": 10, "seed": 42}),
    "svc": ("svc", {"maxIter": 50, "regParam": 0.01}),
    "bayes": ("bayes", {"modelType": "gaussian"}),
    "loan_forest": ("forest_regression", {"numTrees": 200, "maxDepth": 5, "seed": 27}),
    "forest_regularised": ("forest", {"numTrees": 500, "maxDepth": 5, "minInstancesPerNode": 15,
                                      "minInfoGain": 0.01, "subsamplingRate": 0.65,
                                      "featureSubsetStrategy": "sqrt", "maxBins": 32, "seed": 42}),
    "boosted_regularised": ("boosted", {"maxIter": 200, "stepSize": 0.01, "maxDepth": 3,
                                        "minInstancesPerNode": 20, "subsamplingRate": 0.6,
                                        "featureSubsetStrategy": "sqrt", "seed": 42}),
    "logistic_regularised": ("logistic", {"elasticNetParam": 0.5, "regParam": 0.1, "maxIter": 200,
                                          "standardization": True}),
    "xgb_regularised": ("boosted", {"maxIter": 200, "maxDepth": 4, "stepSize": 0.01, "subsamplingRate": 0.7,
                                    "featureSubsetStrategy": "0.7", "minInstancesPerNode": 10, "seed": 42}),
    "lgb_regularised": ("boosted", {"maxIter": 300, "maxDepth": 5, "stepSize": 0.01, "subsamplingRate": 0.7,
                                    "featureSubsetStrategy": "0.7", "minInstancesPerNode": 30, "seed": 42}),
}
BASE_MODELS = ["forest", "boosted", "xgb_like", "lgb_like", "lasso"]


def estimator(preset: str, label: str = "label", features: str = "features", weight: str | None = None,
              **override):
    family, params = PRESETS.get(preset, (preset, {}))
    est = FAMILIES[family](labelCol=label, featuresCol=features)
    settings = {**params, **override}
    if weight:
        settings["weightCol"] = weight
    if est.hasParam("aggregationDepth"):
        settings.setdefault("aggregationDepth", 3)
    if est.hasParam("maxMemoryInMB"):
        settings.setdefault("maxMemoryInMB", 512)
    for name, value in settings.items():
        est.set(est.getParam(name), est.getParam(name).typeConverter(value))
    return est


def fit(preset: str, train: DataFrame, **kwargs):
    return estimator(preset, **kwargs).fit(train)


def fit_many(jobs: dict[str, Callable], threads: int = 8) -> dict:
    """Run independent fits from a few driver threads; Spark shares the executors."""
    inherit = inheritable_thread_target(SparkSession.getActiveSession())
    with ThreadPoolExecutor(threads) as pool:
        started = {n: pool.submit(inherit(job)) for n, job in jobs.items()}
        return {n: f.result() for n, f in started.items()}


def score(model, df: DataFrame, name: str = "prob") -> DataFrame:
    """Add the class-1 probability; a model without one gives the logistic of its margin."""
    if isinstance(model, (TreeModel, LinearScore)):
        return model.score(df, name)
    out = model.transform(df)
    if "probability" in out.columns:
        p = C.class_probability(F.col("probability"))
    else:
        p = C.logistic(C.class_probability(F.col("rawPrediction")))
    drop = [c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns]
    return out.withColumn(name, p).drop(*drop)


def fit_families(train: DataFrame, key: str, presets: dict[str, dict], held: Sequence[int | None] = (None,),
                 final: dict[str, dict] | None = None, weight: str | None = None, penalty_folds: int = 3) -> dict:
    """(preset, held-out fold) to model; None holds nothing out. With folds, `train` has a column `fold`.

    Tree families of `boosting.SPECS` and the lasso share one table of binned rows, and every fold is fitted in the same
    passes. Other presets are separate fits of Spark's learners. `final` overrides settings of the fits on all rows.
    """
    folds = [-2 if f is None else f for f in held]
    settings = lambda n, f: {**presets[n], **((final or {}).get(n, {}) if f is None else {})}
    shared = [n for n in presets if n in B.SPECS or n == "lasso"]
    models: dict = {}
    if shared:
        data = B.bin_rows(train, key, weight=weight, fold="fold" if any(f >= 0 for f in folds) else None)
        trees = [(n, f) for n in shared if n != "lasso" for f in held]
        if trees:
            jobs = [B.Job(replace(B.SPECS[n], **settings(n, f)), -2 if f is None else f) for n, f in trees]
            models.update(zip(trees, B.fit_trees(data, jobs)))
        if "lasso" in shared:
            models.update({("lasso", f): path.model() for f, path in zip(held, penalty_paths(data, folds, penalty_folds))})
    jobs = {(n, f): (lambda n=n, f=f: fit(n, train if f is None else train.filter(F.col("fold") != f), weight=weight, **settings(n, f)))
            for n in presets if n not in shared for f in held}
    models.update(fit_many(jobs))
    return models


# What `forest_spec` takes over; Spark's learner is asked for anything else.
FOREST_SETTINGS = {"numTrees", "maxDepth", "minInstancesPerNode", "featureSubsetStrategy", "subsamplingRate", "seed"}


def forest_spec(settings: dict, n_features: int, regression: bool = False) -> B.Spec:
    """Settings of Spark's forests as those of `boosting`."""
    share = settings.get("featureSubsetStrategy", "auto")
    share = ("onethird" if regression else "sqrt") if share == "auto" else share
    named = {"sqrt": math.sqrt(n_features), "onethird": n_features / 3, "log2": math.log2(max(n_features, 2)), "all": n_features}
    columns = named[share] if share in named else int(share) if share.isdigit() else float(share) * n_features
    return B.Spec(rounds=settings["numTrees"], depth=settings.get("maxDepth", 5), min_rows=settings.get("minInstancesPerNode", 1),
                  row_share=settings.get("subsamplingRate", 1.0), columns=min(max(1, math.ceil(columns)), n_features), forest=True,
                  seed=settings.get("seed", 42))


def bin_amounts(train: DataFrame, key: str, fold: str | None = None) -> tuple[B.Binned, float]:
    """Binned rows for forests on amounts, and the power of two that their labels are divided by: sums of multiples of 2^-20 are exact."""
    most = train.agg(F.max(F.abs("label"))).first()[0] or 0.0
    unit = 2.0 ** math.frexp(float(most))[1]
    label = F.col("label").cast("double")
    known = F.when(label.isNull() | F.isnan(label), F.raise_error(F.lit("Labels MUST NOT be Null or NaN"))).otherwise(label)
    return B.bin_rows(train.withColumn("label", known / unit), key, fold=fold), unit


def fit_amounts(data: B.Binned, unit: float, jobs: Sequence[B.Job]) -> list[TreeModel]:
    """Forests on amounts, with leaves in the label's own unit."""
    models = B.fit_trees(data, jobs)
    return [replace(m, trees=[{**t, "value": t["value"] * unit} for t in m.trees]) for m in models]


def fit_recommender(ratings: DataFrame, user: str = "user_id", item: str = "item_id",
                    rating: str = "rating", **override):
    """Factors by alternating least squares; more ratings are dealt to more blocks, so that a block and what it is sent stay small."""
    blocks = max(10, -(-ratings.count() // BLOCK_RATINGS))
    params = {"rank": 10, "maxIter": 10, "regParam": 0.1, "coldStartStrategy": "drop", "seed": 42,
              "numUserBlocks": blocks, "numItemBlocks": blocks, **override}
    return ALS(userCol=user, itemCol=item, ratingCol=rating, **params).fit(ratings)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of rows, summed one term after the other in 32 bits, as the learner's own search does."""
    out = np.zeros(len(x), np.float32)
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def recommend(model, n: int = 5) -> DataFrame:
    """(user, rank, item, rating) rows: the n items of the highest ratings per user, of equal ones the larger ids.

    Exact, by blocks: the longest item factors give each user a rating that its n-th best cannot fall below; a block of users
    meets a block of items only if some product of lengths can reach that.
    """
    user, item = model.getUserCol(), model.getItemCol()
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    items = keep(model.itemFactors.select("id", "features", length.alias("length")))
    users = model.userFactors.select("id", "features")
    longest = items.orderBy(F.desc("length"), "id").limit(LONGEST).select("features").toArrow().column(0)
    head = np.stack(longest.to_numpy()).astype(np.float32) if len(longest) else np.zeros((0, model.rank), np.float32)
    reach = float(np.linalg.norm(head.astype(float), axis=1).max(initial=0))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack(b.column(1).to_numpy(zero_copy_only=False)).astype(np.float32)
            low = np.full(len(x), -np.inf)
            for i in range(0, len(x) if len(head) >= n else 0, SCORED):
                low[i:i + SCORED] = np.partition(x[i:i + SCORED] @ head.T, -n, axis=1)[:, -n]
            size = np.linalg.norm(x.astype(float), axis=1)
            low -= ROUNDING * size * reach
            need = np.divide(low, size, out=np.full(len(x), -np.inf), where=size > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(low), pa.array(need)], ["id", "features", "low", "need"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.stack(b.column(1).to_numpy(zero_copy_only=False)).astype(np.float32)
                more = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in b.columns[2:]]
                ids = b.column(0).to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes()]) for v in (ids, x, more[0], more[-1])] + [pa.array([more[-1].min()]), pa.array([more[-1].max()])],
                    ["ids", "x", "a", "b", "least", "most"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, x, low, need, others, y, top in zip(*b.columns):
                ids, others = (np.frombuffer(v.as_buffer(), np.int64) for v in (ids, others))
                x, y = (np.frombuffer(v.as_buffer(), np.float32).reshape(len(i), -1) for v, i in ((x, ids), (y, others)))
                low, need = (np.frombuffer(v.as_buffer(), float) for v in (low, need))
                able = np.flatnonzero(need <= top.as_py())
                for i in range(0, len(able), SCORED):
                    some = able[i:i + SCORED]
                    s = x[some] @ y.T
                    bar = low[some]
                    if s.shape[1] > n:
                        room = ROUNDING * reach * np.linalg.norm(x[some].astype(float), axis=1)
                        many = np.flatnonzero((s >= bar[:, None]).sum(axis=1) > n)
                        bar[many] = np.maximum(bar[many], np.partition(s[many], -n, axis=1)[:, -n] - room[many])
                    row, at = np.nonzero(s >= bar[:, None])
                    rating = products(x[some[row]], y[at])
                    order = np.lexsort((-others[at], -rating, row))
                    order = order[np.arange(len(row)) - np.searchsorted(row, row) < n]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some[row[order]]].astype(np.int32)), pa.array(others[at[order]].astype(np.int32)),
                                                      pa.array(rating[order])], [user, item, "rating"])

    packed = "ids binary, x binary, a binary, b binary, least double, most double"
    asked = keep(users.mapInArrow(floors, "id int, features array<float>, low double, need double"))
    n_users, n_items = asked.count(), items.count()
    per_task = 1 << 13
    left = keep(asked.repartitionByRange(-(-n_users // per_task) or 1, "need").sortWithinPartitions("need").mapInArrow(pack, packed))
    right = keep(items.repartitionByRange(-(-n_items // per_task) or 1, F.desc("length")).sortWithinPartitions(F.desc("length")).mapInArrow(pack, packed))
    left = left.repartition(-(-n_users // per_task) or 1).select("ids", "x", "a", "b", "least")
    right = right.repartition(-(-n_items // (per_task << 5)) or 1).select(F.col("ids").alias("others"), F.col("x").alias("y"), F.col("most").alias("top"))
    met = left.join(right, F.col("least") <= F.col("top")).select("ids", "x", "a", "b", "others", "y", "top")
    found = met.mapInArrow(best, f"{user} int, {item} int, rating float")
    order = Window.partitionBy(user).orderBy(F.desc("rating"), F.desc(item))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(user, "rank", item, "rating")
