"""Training jobs: fit on train, measure on validation at one half, log the run, save the model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.functions.labels import label_binary
from holdfast.operators import evaluation, training
from holdfast.sources import registry
from holdfast.spec import LogisticSpec, ModelingSpec, SearchSpec

LOGGED_CUT = 0.5


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    run_id: str


def validation_metrics(
    model: PipelineModel, validation: DataFrame, spec: ModelingSpec
) -> dict[str, float]:
    """Metrics of the validation rows. Their scores are written first: the model runs once."""
    scored = training.score_rows(model, validation, "_p").select(
        "_p", label_binary(spec.label).alias("_label")
    )
    path = workspace.new_path(validation.sparkSession, "validation_scores")
    scored.write.parquet(path)
    scored = validation.sparkSession.read.schema(scored.schema).parquet(path)
    row = evaluation.fixed_cut_metrics(scored, "_p", "_label", LOGGED_CUT).first()
    return {f"val_{k}": float(v) for k, v in row.asDict().items() if v is not None}


def _sizes(train: DataFrame, validation: DataFrame) -> dict[str, int]:
    """Rows of both, in one job."""
    both = train.select(F.lit(0).alias("val")).unionAll(validation.select(F.lit(1).alias("val")))
    row = both.agg(F.count_if(F.col("val") == 0).alias("t"), F.count_if(F.col("val") == 1).alias("v")).first()
    return {"n_train": row["t"], "n_val": row["v"]}


def train_logistic_job(
    train: DataFrame,
    validation: DataFrame,
    spec: ModelingSpec,
    *,
    model_path: str,
    runs_path: str,
    settings: LogisticSpec = LogisticSpec(),
    name: str = "baseline_logistic",
) -> Trained:
    training.fit_logistic(train, spec, settings).write().overwrite().save(model_path)
    # The saved model, unlike the fitted one, carries no training summary into its tasks.
    model = PipelineModel.load(model_path)
    metrics = validation_metrics(model, validation, spec)
    params = {
        "inverse_penalty": settings.inverse_penalty,
        "max_iter": settings.max_iter,
        "class_weight": settings.class_weight,
        "seed": settings.seed,
        **_sizes(train, validation),
    }
    row = registry.run_row(name, params, metrics, {"model_family": "logistic_regression"})
    registry.log_runs(train.sparkSession, runs_path, [row])
    return Trained(model, metrics, row[0])


def best_settings(search: SearchSpec, result: training.SearchResult, metrics: dict) -> dict:
    """Record of a search: its score, the validation metrics and the full settings used."""
    return {
        "cv_best_mean_roc_auc": result.best_score,
        "validation_metrics": dict(metrics),
        "settings": {**dict(search.fixed), **result.best, "seed": search.seed},
    }


def train_trees_job(
    train: DataFrame,
    validation: DataFrame,
    spec: ModelingSpec,
    *,
    model_path: str,
    runs_path: str,
    search: SearchSpec = SearchSpec(),
    name: str = "trees_random_search",
    ledger: str | None = None,
) -> tuple[Trained, training.SearchResult]:
    """Search, refit, measure, log and save. With a ``ledger`` path, a job that lost its driver and
    is started again repeats no fit of its search (see ``random_search``)."""
    result = training.random_search(train, spec, search, ledger)
    metrics = validation_metrics(result.model, validation, spec)
    result.model.write().overwrite().save(model_path)
    best = best_settings(search, result, metrics)
    params = {
        "folds": search.folds,
        "draws": search.draws,
        "scoring": "roc_auc",
        **{f"best_{k}": v for k, v in best["settings"].items()},
        **_sizes(train, validation),
    }
    parent = registry.run_row(
        name,
        params,
        {**metrics, "cv_best_mean_roc_auc": result.best_score},
        {"model_family": "gradient_boosted_trees"},
    )
    # One row per draw: bounded by the search settings.
    drawn = training.trial_table(
        result.trials.withColumn("params", F.to_json("params")), keep=["params"]
    ).withColumn("params", F.from_json("params", "map<string,string>"))
    children = [
        registry.run_row(
            f"trial_{r['trial'] + 1}",
            r["params"],
            {"cv_mean_roc_auc": r["mean_roc_auc"], "cv_std_roc_auc": r["std_roc_auc"]},
            {"model_family": "gradient_boosted_trees"},
            parent=parent[0],
        )
        for r in drawn.collect()
    ]
    registry.log_runs(train.sparkSession, runs_path, [parent, *children])
    return Trained(result.model, metrics, parent[0]), result
