"""Class weights, the logistic baseline, boosted trees and their random search."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.labels import label_binary
from holdfast.operators import features, splitting
from holdfast.sources.ledger import SearchLedger, point_key, search_key
from holdfast.spec import LabelSpec, LogisticSpec, ModelingSpec, SearchSpec
from holdfast.workspace import new_path

SCORE = "churn_probability"
#: Helper columns beside a table's own: the underscore keeps them apart.
Y, WEIGHT, RAW, PROBABILITY = "_y", "_weight", "_raw", "_probability"
BALANCED, UNBALANCE = "balanced", "unbalance"


def class_weights(df: DataFrame, label: LabelSpec, mode: str = BALANCED) -> DataFrame:
    """(y, n_rows, weight) for both classes.

    balanced: total over classes times class size. unbalance: the rarer class gets the size
    ratio, the other one 1.
    """
    y = label_binary(label)
    sizes = df.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    if mode == BALANCED:
        present = F.when((n0 > 0) & (n1 > 0), 2.0).otherwise(1.0)
        w0, w1 = F.try_divide(n0 + n1, present * n0), F.try_divide(n0 + n1, present * n1)
    elif mode == UNBALANCE:
        w0 = F.greatest(F.lit(1.0), F.try_divide(n1, n0))
        w1 = F.greatest(F.lit(1.0), F.try_divide(n0, n1))
    else:
        raise ValueError(f"unknown weighting {mode!r}")

    def row(value: int, n: str, weight: Column) -> Column:
        return F.struct(F.lit(value).alias("y"), F.col(n).alias("n_rows"), weight.alias("weight"))

    return sizes.select(F.inline(F.array(row(0, "n0", w0), row(1, "n1", w1))))


def with_weight(df: DataFrame, label: LabelSpec, mode: str | None) -> DataFrame:
    """Rows with 0/1 label and weight; the two weights are literals, so no join is needed."""
    y = label_binary(label)
    if mode is None:
        return df.select("*", y.alias(Y), F.lit(1.0).alias(WEIGHT))
    weights = {r["y"]: r["weight"] or 1.0 for r in class_weights(df, label, mode).collect()}
    weight = F.when(y == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
    return df.select("*", y.alias(Y), weight.alias(WEIGHT))


def positive_probability() -> Column:
    return vector_to_array(F.col(PROBABILITY))[1]


#: Column names shared by both classifiers.
_COLUMNS = {
    "labelCol": Y,
    "weightCol": WEIGHT,
    "featuresCol": features.FEATURES,
    "predictionCol": "_prediction",
}


def score_rows(model: PipelineModel, df: DataFrame, score: str = SCORE) -> DataFrame:
    """The rows with the probability of the positive label."""
    return model.transform(df).select(*df.columns, positive_probability().alias(score))


def fit_logistic(
    train: DataFrame, spec: ModelingSpec, settings: LogisticSpec = LogisticSpec()
) -> PipelineModel:
    """Features and weighted L2 logistic regression as one model.

    The penalty is stated per row weight, so it is the inverse penalty over the weight total.
    """
    prepared, _ = features.fit_features(train, spec)
    weighted = with_weight(train, spec.label, settings.class_weight)
    total = float(weighted.agg(F.sum(WEIGHT)).first()[0])
    rows = prepared.transform(weighted).select(Y, WEIGHT, features.FEATURES)
    classifier = LogisticRegression(
        **_COLUMNS,
        rawPredictionCol=RAW,
        probabilityCol=PROBABILITY,
        maxIter=settings.max_iter,
        tol=settings.tolerance,
        regParam=1.0 / (settings.inverse_penalty * total),
        elasticNetParam=0.0,
        standardization=False,
    ).fit(rows)
    return PipelineModel(stages=[*prepared.stages, classifier])


def tree_settings(point: Mapping[str, Any]) -> dict[str, Any]:
    """Spark tree settings for a point of the search grid.

    ``num_leaves`` only sets the depth when none is given and ``reg_lambda`` has no counterpart:
    Spark grows trees level by level, without leaf penalties. ``subsample`` is not passed on
    either: without a bagging frequency it takes no effect.
    """
    out: dict[str, Any] = {}
    if "learning_rate" in point:
        out["stepSize"] = float(point["learning_rate"])
    if "n_estimators" in point:
        out["maxIter"] = int(point["n_estimators"])
    depth = int(point.get("max_depth", -1))
    if depth <= 0:
        depth = math.ceil(math.log2(int(point.get("num_leaves", 31))))
    out["maxDepth"] = depth
    if "min_child_samples" in point:
        out["minInstancesPerNode"] = int(point["min_child_samples"])
    if "colsample_bytree" in point:
        share = float(point["colsample_bytree"])
        out["featureSubsetStrategy"] = "all" if share >= 1.0 else str(share)
    return out


def _trees(point: Mapping[str, Any], seed: int) -> GBTClassifier:
    trees = GBTClassifier(**_COLUMNS, seed=seed, **tree_settings(point))
    return trees.setRawPredictionCol(RAW).setProbabilityCol(PROBABILITY)


def fit_trees(
    train: DataFrame, spec: ModelingSpec, point: Mapping[str, Any], seed: int = 42,
    unbalance: bool = True,
) -> PipelineModel:
    """Features and gradient-boosted trees as one model."""
    prepared, _ = features.fit_features(train, spec)
    weighted = with_weight(train, spec.label, UNBALANCE if unbalance else None)
    rows = prepared.transform(weighted).select(Y, WEIGHT, features.FEATURES)
    return PipelineModel(stages=[*prepared.stages, _trees(point, seed).fit(rows)])


def draw_points(search: SearchSpec) -> list[dict[str, Any]]:
    """Seeded draw of grid points without repetition; the grid itself is never laid out."""
    names = sorted(search.grid)
    sizes = [len(search.grid[n]) for n in names]
    total = math.prod(sizes)
    points = []
    for place in random.Random(search.seed).sample(range(total), min(search.draws, total)):
        point = {}
        for name, size in zip(names, sizes):
            place, at = divmod(place, size)
            point[name] = search.grid[name][at]
        points.append(point)
    return points


@dataclass(frozen=True)
class SearchResult:
    """Best model refitted on all training rows, its settings, and every trial's fold scores."""

    model: PipelineModel
    best: dict[str, Any]
    best_score: float
    trials: DataFrame


def random_search(
    train: DataFrame, spec: ModelingSpec, search: SearchSpec, ledger: str | None = None
) -> SearchResult:
    """Random search over boosted trees, scored by ROC-AUC on stratified folds.

    Features are fitted once per fold, on that fold's training part, and shared by all its
    trials; trials of a fold run side by side as Spark jobs.

    Every fit is written to a ledger as it ends, and trials, best trial and refit come from there.
    With a ``ledger`` path of its own a search that lost its driver goes on where it stood: only
    fits without a result are done, and folds that have all theirs are not even prepared. More draws
    over the same rows add to the results that are there. Without a path the ledger is a table
    between steps of this process.
    """
    spark = train.sparkSession
    points = [{**search.fixed, **p} for p in draw_points(search)]
    book = SearchLedger(
        spark, ledger or new_path(spark, "ledger"), search_key(train, spec, search)
    )
    finished = book.finished()
    for fold in range(search.folds):
        missing = [p for p in points if (point_key(p), fold) not in finished]
        if missing:
            _fit_fold(train, spec, search, book, fold, missing)

    trials = book.trials(points)
    best = best_trial(trials).first()
    winner = points[best["trial"]]
    model = fit_trees(train, spec, winner, search.seed, search.unbalance)
    return SearchResult(model, winner, best["mean_roc_auc"], trials)


def _fit_fold(
    train: DataFrame,
    spec: ModelingSpec,
    search: SearchSpec,
    book: SearchLedger,
    fold: int,
    points: Sequence[Mapping[str, Any]],
) -> None:
    """Fit and judge the points on one fold; each result goes to the ledger as it is known."""
    folded = splitting.stratified_folds(
        train, spec.id_column, spec.label.column, search.folds, search.seed
    )
    judge = BinaryClassificationEvaluator(
        labelCol=Y, rawPredictionCol=RAW, metricName="areaUnderROC", numBins=0
    )
    kept = folded.where(F.col("fold") != fold).drop("fold")
    held = folded.where(F.col("fold") == fold).drop("fold")
    prepared, _ = features.fit_features(kept, spec)
    mode = UNBALANCE if search.unbalance else None
    fit_rows = prepared.transform(with_weight(kept, spec.label, mode)).select(
        Y, WEIGHT, features.FEATURES
    ).persist(StorageLevel.MEMORY_AND_DISK)
    judge_rows = prepared.transform(
        held.select("*", label_binary(spec.label).alias(Y))
    ).select(Y, features.FEATURES).persist(StorageLevel.MEMORY_AND_DISK)

    def one(point: Mapping[str, Any]) -> None:
        model = _trees(point, search.seed).fit(fit_rows)
        book.append(point, fold, judge.evaluate(model.transform(judge_rows)))

    try:
        with ThreadPool(min(search.parallelism, len(points))) as pool:
            pool.map(inheritable_thread_target(train.sparkSession)(one), points)
    finally:
        fit_rows.unpersist()
        judge_rows.unpersist()


def trial_table(trials: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(trial, mean, deviation over folds, place): best mean first, earliest trial on ties."""
    per_trial = trials.groupBy("trial", *keep).agg(
        F.avg("roc_auc").alias("mean_roc_auc"), F.stddev_pop("roc_auc").alias("std_roc_auc")
    )
    return per_trial.orderBy(F.desc("mean_roc_auc"), "trial")


def best_trial(trials: DataFrame) -> DataFrame:
    return trial_table(trials).limit(1)


def model_coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, coefficient) of a fitted or loaded logistic model, intercept first."""
    fitted = model.stages[-1]
    names = features.model_feature_names(model)
    return [("(intercept)", float(fitted.intercept))] + [
        (n, float(c)) for n, c in zip(names, fitted.coefficients.toArray(), strict=True)
    ]
