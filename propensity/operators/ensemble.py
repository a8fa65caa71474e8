"""Votes, weighted averages, stacking and blending of several models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.operators import metrics as E
from propensity.operators.features import assemble
from propensity.operators.models import fit_families, score
from propensity.operators.ordered import arg_best
from propensity.operators.sampling import stratified_folds
from propensity.session import keep


def hard_vote(columns: Sequence[str], threshold: float = 0.5, needed: int | None = None) -> Column:
    """1 when at least `needed` scores (default a majority) reach the threshold."""
    votes = sum(((F.col(c) >= threshold).cast("int") for c in columns), F.lit(0))
    return (votes >= (needed or len(columns) // 2 + 1)).cast("int")


def soft_vote(columns: Sequence[str]) -> Column:
    return sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns)


def weighted(columns: Sequence[str], weights: Column) -> Column:
    """Sum of score times weight; `weights` is a struct with the score names."""
    return sum((F.col(c) * weights[c] for c in columns), F.lit(0.0))


def auc_weights(df: DataFrame, label: str, columns: Sequence[str]) -> Column:
    """AUC of each score over their sum, as a struct (scalar subquery, one row)."""
    long = df.unpivot([label], list(columns), "model", "p")
    aucs = E.auc_roc(long, label, "p", ["model"])
    total = F.sum("auc")
    return aucs.agg(F.struct(*[
        (F.max(F.when(F.col("model") == c, F.col("auc"))) / total).alias(c) for c in columns])).scalar()


def simplex(parts: int, steps: int) -> list[tuple[int, ...]]:
    """All whole-number weights with the given sum."""
    if parts == 1:
        return [(steps,)]
    return [(i, *rest) for i in range(steps + 1) for rest in simplex(parts - 1, steps - i)]


def search_weights(df: DataFrame, label: str, columns: Sequence[str], steps: int = 4,
                   scale: int = 10000) -> DataFrame:
    """AUC of every weight vector on the simplex grid; the first best is marked.

    Scores are whole units of 1/scale, so a mix is an exact whole number and a candidate
    has at most steps * scale + 1 distinct mixes. They are counted on the map side, which
    keeps the shuffle small whatever the number of rows.
    """
    grid = simplex(len(columns), steps)
    units = {c: F.round(F.col(c) * scale).cast("bigint").alias(c) for c in columns}
    mixes = ", ".join(" + ".join(f"{w} * {c}" for w, c in zip(g, columns) if w) for g in grid)
    mixed = df.select(*units.values(), F.col(label).alias("label")).select(
        "label", F.expr(f"posexplode(array({mixes})) AS (candidate, mix)"))
    counts = mixed.groupBy("candidate", "mix").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    run = E.running_totals(counts, "mix", ["pos", "neg"], ["candidate"])
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    auc = run.groupBy("candidate").agg(
        F.try_divide(wins, (F.max("all_pos") * F.max("all_neg")).cast("double")).alias("auc"))
    weights = F.expr("array(" + ", ".join(
        "struct(" + ", ".join(f"{w} AS w_{c}" for w, c in zip(g, columns)) + ")" for g in grid) + ")")
    own = auc.withColumn("g", F.element_at(weights, F.col("candidate") + 1))
    return own.select("candidate", *[F.col(f"g.w_{c}") for c in columns], "auc")


def best_weights(candidates: DataFrame) -> DataFrame:
    return arg_best(candidates, "auc", "candidate")


def refine_weights(df: DataFrame, label: str, columns: Sequence[str], smallest: float = 1 / 64) -> DataFrame:
    """One row: weights on the simplex found by pattern search, with the exact AUC of their mix.

    From equal weights, weight moves in steps between every two scores; the step is halved when no
    move helps, down to `smallest`. All moves of a round are judged in one job on unrounded scores.
    """
    rows = keep(df.select(F.col(label).alias("label"), *columns))
    best, step, auc = [1 / len(columns)] * len(columns), 0.25, -1.0
    while step >= smallest:
        moves = [best]
        for i in range(len(columns)):
            for j in range(len(columns)):
                if i != j and best[j] >= step - 1e-12:
                    moves.append([w + step * ((k == i) - (k == j)) for k, w in enumerate(best)])
        mixes = F.array(*[sum((F.col(c) * F.lit(float(w)) for c, w in zip(columns, m)), F.lit(0.0)) for m in moves])
        long = rows.select("label", F.posexplode(mixes).alias("model", "p"))
        top = E.auc_roc(long, "label", "p", ["model"]).orderBy(F.desc("auc"), "model").first()
        if top is None or top.auc is None:
            break
        if top.auc > auc + 1e-12:
            best, auc = moves[top.model], float(top.auc)
        else:
            step /= 2
    return df.sparkSession.createDataFrame([(*map(float, best), auc)], [*[f"w_{c}" for c in columns], "auc"])


@dataclass(frozen=True)
class Stack:
    base: dict
    meta: object
    columns: tuple[str, ...]

    def score(self, rows: DataFrame, name: str = "prob_stack") -> DataFrame:
        return score_meta(self.meta, score_all(self.base, rows), self.columns, name)


def score_all(models: dict, rows: DataFrame) -> DataFrame:
    """Add prob_<name> for every model; one pass over the rows, which are few bytes and much work: a part for each core."""
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    return reduce(lambda df, kv: score(kv[1], df, f"prob_{kv[0]}"), models.items(), rows)


def score_meta(meta, scored: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    wide = assemble(scored.withColumnRenamed("features", "__base"), columns)
    return score(meta, wide, name).drop("features").withColumnRenamed("__base", "features")


def held_out_scores(models: dict, rows: DataFrame, presets: dict[str, dict], folds: int) -> DataFrame:
    """prob_<name> of each row by the models that did not see its fold."""
    parts = [score_all({n: models[n, f] for n in presets}, rows.filter(F.col("fold") == f)) for f in range(folds)]
    return reduce(DataFrame.unionByName, parts)


def out_of_fold(train: DataFrame, key: str, presets: dict[str, dict], folds: int = 5) -> DataFrame:
    """Scores of each row by models that did not see its fold; every key occurs once."""
    rows = keep(stratified_folds(train, key, "label", folds))
    return held_out_scores(fit_families(rows, key, presets, range(folds)), rows, presets, folds)


def fit_meta(scored: DataFrame, key: str, columns: Sequence[str], meta: str = "lasso"):
    """Meta model on score columns; a lasso takes the penalty that cross-validation finds best."""
    return fit_families(assemble(scored.drop("features", "fold"), columns), key, {meta: {}}, penalty_folds=5)[meta, None]


def fit_stack(train: DataFrame, key: str, presets: dict[str, dict], folds: int = 5, meta: str = "lasso",
              final: dict[str, dict] | None = None) -> Stack:
    """Meta model on out-of-fold scores; base models of all training rows are fitted in the same passes as those of the folds."""
    rows = keep(stratified_folds(train, key, "label", folds))
    models = fit_families(rows, key, presets, [*range(folds), None], final)
    columns = tuple(f"prob_{n}" for n in presets)
    oof = keep(held_out_scores(models, rows, presets, folds).select(key, "label", *columns))
    return Stack({n: models[n, None] for n in presets}, fit_meta(oof, key, columns, meta), columns)


def fit_blend(train: DataFrame, val: DataFrame, key: str, presets: dict[str, dict], meta: str = "lasso") -> Stack:
    """Base models on the training rows, meta model on their validation scores."""
    models = fit_families(train, key, presets)
    base = {n: models[n, None] for n in presets}
    columns = tuple(f"prob_{n}" for n in presets)
    return Stack(base, fit_meta(keep(score_all(base, val).select(key, "label", *columns)), key, columns, meta), columns)
