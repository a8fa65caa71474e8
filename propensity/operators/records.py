"""Run log, model register and saved model bundles, kept as files any reader can open."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.operators.boosting import TreeModel, load_trees, save_trees
from propensity.operators.penalised import LinearScore
from propensity.session import new_path

RUN_SCHEMA = "run_id string, kind string, key string, value string"
REGISTER_SCHEMA = "name string, version int, stage string, seq int"


def log_values(wide: DataFrame, run_id: str, params: list[str], metrics: list[str],
               tags: list[str]) -> DataFrame:
    """One row per run to long (run_id, kind, key, value) rows."""
    kinds = [("param", params), ("metric", metrics), ("tag", tags)]
    cells = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("key"),
                               F.col(c).cast("string").alias("value"))
                      for kind, cols in kinds for c in cols])
    return wide.select(F.col(run_id).alias("run_id"), F.inline(cells))


def append_log(rows: DataFrame, path: str) -> str:
    rows.write.mode("append").parquet(path)
    return path


def search_runs(log: DataFrame, metric: str, above: float, columns: dict[str, str],
                limit: int = 10) -> DataFrame:
    """Runs whose metric exceeds a value, best first. `columns`: output name -> 'kind.key'."""
    picked = log.groupBy("run_id").agg(
        F.max(F.when((F.col("kind") == "metric") & (F.col("key") == metric),
                     F.col("value").try_cast("double"))).alias("__m"),
        *[F.max(F.when(F.concat_ws(".", "kind", "key") == src, F.col("value"))).alias(name)
          for name, src in columns.items()])
    return (picked.filter(F.col("__m") > above).orderBy(F.desc("__m"), "run_id").limit(limit)
            .drop("__m"))


def current_stages(register: DataFrame) -> DataFrame:
    """Latest stage of each (name, version)."""
    return register.groupBy("name", "version").agg(F.max_by("stage", "seq").alias("stage"))


def production_version(register: DataFrame) -> DataFrame:
    now = current_stages(register).filter(F.col("stage") == "Production")
    return now.groupBy("name").agg(F.max("version").alias("version"))


def save_model(spark: SparkSession, model, name: str = "model") -> str:
    path = new_path(spark, name)
    model.write().overwrite().save(path)
    return path


def save_bundle(spark: SparkSession, models: dict, details: dict,
                medians: DataFrame | None = None) -> str:
    """Models, optional medians and one row of details under one folder."""
    path = new_path(spark, "bundle")
    kinds = {}
    for name, model in models.items():
        kinds[name] = _save(spark, model, f"{path}/models/{name}")
    text = {k: str(v) for k, v in details.items()}
    rows = [(k, v) for k, v in sorted({**text, "models": ",".join(f"{n}:{kinds[n]}" for n in sorted(models))}.items())]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(f"{path}/details")
    if medians is not None:
        medians.write.parquet(f"{path}/medians")
    return path


def load_bundle(spark: SparkSession, path: str) -> tuple[dict, dict[str, str]]:
    details = {r.key: r.value for r in spark.read.parquet(f"{path}/details").collect()}
    pairs = [x.split(":") for x in details["models"].split(",")]
    return {n: _load(spark, kind, f"{path}/models/{n}") for n, kind in pairs}, details


def _save(spark: SparkSession, model, path: str) -> str:
    if isinstance(model, TreeModel):
        save_trees(spark, model, path)
        return "trees"
    if isinstance(model, LinearScore):
        spark.createDataFrame([(model.intercept, model.coefficients.tolist(), model.penalty)],
                              "intercept double, coefficients array<double>, penalty double").write.parquet(path)
        return "linear"
    model.write().save(path)
    return "pipeline"


def _load(spark: SparkSession, kind: str, path: str):
    if kind == "trees":
        return load_trees(spark, path)
    if kind == "linear":
        r = spark.read.parquet(path).first()
        return LinearScore(r.intercept, np.array(r.coefficients), r.penalty)
    return PipelineModel.load(path)
