"""Evaluation job: score the held-out splits once, choose the cut, report, freeze the champion."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.labels import label_binary
from holdfast.operators import evaluation, ranking, threshold, training
from holdfast.sources import registry, sinks
from holdfast.spec import EvalSpec, ModelingSpec


def _kept(table: DataFrame, path: str) -> DataFrame:
    """Write a table and go on from what was written."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def score_held_out(model: PipelineModel, split: DataFrame, spec: ModelingSpec) -> DataFrame:
    """(split, y, score) of the validation and test rows."""
    if spec.label.column not in split.columns:
        raise ValueError(f"label column {spec.label.column!r} is missing")
    held = split.where(F.col("split").isin(evaluation.VALIDATION, evaluation.TEST))
    scored = training.score_rows(model, held, "_score")
    return scored.select(
        "split", label_binary(spec.label).alias("y"), F.col("_score").alias("score")
    )


def evaluation_job(
    split: DataFrame,
    spec: ModelingSpec,
    output: str,
    *,
    champion_path: str,
    model_override: str | None = None,
    champion_model: str | None = None,
    fallback_model: str | None = None,
    settings: EvalSpec = EvalSpec(),
) -> DataFrame:
    """The evaluation summary; also written, and the champion appended to its table.

    Scores are written first: every metric then reads three narrow columns, and no executor
    loss makes the model run again. Beside the summary stand the choice of the cut with its
    warning (``threshold_choice.json``) and the series behind the figures: ``threshold_sweep`` on
    validation, ``confusion_matrix`` on test at the cut, ``roc_curve`` and ``pr_curve`` of both.
    """
    spark = split.sparkSession
    model_path, source = registry.resolve_model(
        spark, model_override, champion_model, fallback_model
    )
    scores_path = f"{output}/held_out_scores.parquet"
    score_held_out(PipelineModel.load(model_path), split, spec).write.mode("overwrite").parquet(
        scores_path
    )
    scored = spark.read.parquet(scores_path)
    validation = scored.where(F.col("split") == evaluation.VALIDATION)
    sweep = _kept(threshold.threshold_sweep(validation, "score", "y", settings), f"{output}/threshold_sweep.parquet")
    choice_path = f"{output}/threshold_choice.json"
    choice = threshold.select_threshold(sweep, settings, spec.label)
    sinks.write_report(choice, choice_path)
    choice = spark.read.schema(choice.schema).json(choice_path)
    chosen = choice.first()
    cumulative = _kept(
        ranking.cumulative_counts(scored, "score", "y", ["split"]), f"{output}/cumulative.parquet"
    )
    ranking.roc_curve(cumulative, ["split"]).write.mode("overwrite").parquet(f"{output}/roc_curve.parquet")
    ranking.pr_curve(cumulative, ["split"]).write.mode("overwrite").parquet(f"{output}/pr_curve.parquet")
    test = scored.where(F.col("split") == evaluation.TEST)
    threshold.confusion_matrix(test, "score", "y", chosen["threshold"]).write.mode("overwrite").parquet(
        f"{output}/confusion_matrix.parquet"
    )
    summary_path = f"{output}/evaluation_summary.json"
    sinks.write_report(
        evaluation.evaluation_summary(
            scored, "score", "y", settings, spec.label, chosen=choice, cumulative=cumulative
        ),
        summary_path,
    )
    summary = spark.read.schema("split string, metric string, value double").json(summary_path)
    # Two splits with six metrics each, and the cut.
    facts = {(r["split"], r["metric"]): r["value"] for r in summary.collect()}
    registry.freeze_champion(
        spark,
        champion_path,
        model_path=model_path,
        model_source=source,
        threshold=chosen["threshold"],
        recall_floor=chosen["recall_floor"],
        beta=chosen["beta"],
        floor_kept=chosen["floor_kept"],
        test_metrics={
            m: facts[(evaluation.TEST, m)]
            for m in evaluation.METRICS
            if facts.get((evaluation.TEST, m)) is not None
        },
    )
    return summary
