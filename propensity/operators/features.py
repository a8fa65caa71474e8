"""Feature preparation. Everything is fitted on one frame and applied to another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, MinMaxScaler, OneHotEncoder, RFormula, StandardScaler,
                                StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.functions import columns as C
from propensity.functions import fixed_values as V
from propensity.operators.aggregates import full_matrix, pair_statistics
from propensity.operators.ordered import exact_quantiles, top_n


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact medians as (feature, median) rows; all columns share one shuffle."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value")
    return exact_quantiles(long, "value", {"median": 0.5}, ["feature"])


def impute(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill nulls and NaN from (feature, median) rows fitted elsewhere."""
    one = fitted.agg(F.struct(*[
        F.max(F.when(F.col("feature") == c, F.col("median"))).alias(c) for c in cols])).scalar()
    filled = {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.col(f"__med.{c}"))
              for c in cols}
    return df.withColumn("__med", one).withColumns(filled).drop("__med")


def index_strings(df: DataFrame, cols: Sequence[str], order: str = "frequencyDesc"):
    """Fitted string indexes; unseen values get the extra last index."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols],
                         stringOrderType=order, handleInvalid="keep").fit(df)


def dummies(df: DataFrame, fitted_on: DataFrame, cols: Sequence[str]) -> DataFrame:
    """0/1 columns for every level seen in `fitted_on`; a level unseen there is all zero."""
    model = index_strings(fitted_on, cols, "alphabetAsc")
    out = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
           for c, levels in zip(cols, model.labelsArray) for v in levels]
    return df.select(*[c for c in df.columns if c not in cols], *out)


def level_table(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNotNull()).distinct()


def align_levels(df: DataFrame, levels: DataFrame, col: str) -> DataFrame:
    """Values not in the saved level table become null."""
    known = levels.select(F.col(col).alias("__level"))
    return (df.join(known, F.col(col) == F.col("__level"), "left")
            .withColumn(col, F.col("__level")).drop("__level"))


def design(df: DataFrame, label: str, cols: Sequence[str]) -> DataFrame:
    """Design matrix of an explicit formula as `features` and `label`."""
    formula = RFormula(formula=f"{label} ~ {' + '.join(cols)}", featuresCol="features",
                       labelCol="label", handleInvalid="keep")
    return formula.fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def scaled(df: DataFrame, fitted_on: DataFrame, cols: Sequence[str], kind: str = "minmax") -> DataFrame:
    """Columns scaled to [0, 1] or to mean 0 and sample deviation 1, fitted on `fitted_on`."""
    scaler = (MinMaxScaler(inputCol="__raw", outputCol="__out") if kind == "minmax" else
              StandardScaler(withMean=True, withStd=True, inputCol="__raw", outputCol="__out"))
    steps = [VectorAssembler(inputCols=list(cols), outputCol="__raw", handleInvalid="keep"), scaler]
    model = Pipeline(stages=steps).fit(fitted_on)
    wide = model.transform(df).withColumn("__arr", vector_to_array("__out"))
    return wide.withColumns({c: F.col("__arr")[i] for i, c in enumerate(cols)}).drop(
        "__raw", "__out", "__arr")


def near_zero_variance(df: DataFrame, cols: Sequence[str], ratio: float = 19.0,
                       unique_pct: float = 10.0) -> DataFrame:
    """Per column: ratio of the two top counts, percent of distinct values, drop flag."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n"))
    top = top_n(counts, ["feature"], [F.desc("n"), "value"], 2)
    lead = top.groupBy("feature").agg(F.max(F.when(F.col("rank") == 1, F.col("n"))).alias("n1"),
                                      F.max(F.when(F.col("rank") == 2, F.col("n"))).alias("n2"))
    size = counts.groupBy("feature").agg(F.count("*").alias("levels"), F.sum("n").alias("rows"))
    r = F.coalesce(F.col("n1") / F.col("n2"), F.lit(0.0))
    pct = F.col("levels") * 100.0 / F.col("rows")
    drop = ((r > ratio) & (pct < unique_pct)) | (F.col("levels") == 1)
    return lead.join(size, "feature").select(
        "feature", r.alias("freq_ratio"), pct.alias("pct_unique"), drop.alias("drop"))


def correlated_columns(df: DataFrame, cols: Sequence[str], cutoff: float = 0.9) -> list[str]:
    """Columns to drop so that no pair left has |r| above the cutoff.

    One pass over the rows gives the pairs; the choice looks only at the column matrix.
    """
    r = {(a, b): abs(v) for a, b, v in full_matrix(pair_statistics(df, cols)).collect()
         if v is not None}
    left = list(cols)

    def mean_abs(c: str) -> float:
        others = [r.get((c, o), 0.0) for o in left if o != c]
        return sum(others) / len(others) if others else 0.0

    while True:
        worst = max(((v, a, b) for (a, b), v in r.items()
                     if a < b and a in left and b in left and v > cutoff), default=None)
        if worst is None:
            return [c for c in cols if c not in left]
        _, a, b = worst
        left.remove(a if mean_abs(a) > mean_abs(b) else b)


@dataclass(frozen=True)
class FeatureSet:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()

    def stages(self, impute_strategy: str = "median") -> list:
        """Imputer, indexer, encoder and assembler for one fitted pipeline."""
        out = []
        names = list(self.numeric)
        if self.numeric:
            names = [f"{c}_imp" for c in self.numeric]
            out.append(Imputer(inputCols=list(self.numeric), outputCols=names,
                               strategy=impute_strategy))
        if self.categorical:
            idx = [f"{c}_idx" for c in self.categorical]
            ohe = [f"{c}_ohe" for c in self.categorical]
            out.append(StringIndexer(inputCols=list(self.categorical), outputCols=idx,
                                     handleInvalid="keep", stringOrderType="alphabetAsc"))
            out.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
            names += ohe
        out.append(VectorAssembler(inputCols=names, outputCol="features"))
        return out

    def fit(self, df: DataFrame) -> PipelineModel:
        return Pipeline(stages=self.stages()).fit(df)


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the vector slots from the column metadata."""
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    flat = [a for group in attrs.values() for a in group]
    return [a["name"] for a in sorted(flat, key=lambda a: a["idx"])]


def charge_columns(df: DataFrame) -> DataFrame:
    """Derived charge columns of the churn table."""
    tenure, total, monthly = F.col("tenure"), F.col("TotalCharges"), F.col("MonthlyCharges")
    return df.withColumns({
        "tenure_sq": (tenure * tenure),
        "avg_charges": C.per_positive(total, tenure),
        "high_value": C.flag(monthly > V.HIGH_VALUE_CHARGES),
        "charge_ratio": C.per_positive(monthly, total),
    })
