"""Evaluation of scored splits: the cut is chosen on validation and only read on test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators import ranking, threshold
from holdfast.spec import EvalSpec, LabelSpec

VALIDATION, TEST = "validation", "test"
METRICS = ("roc_auc", "average_precision", "recall", "precision", "f1", "fbeta")


def metrics_at(
    cumulative: DataFrame, cut: float | Column, beta: float = 1.0, by: Sequence[str] = ()
) -> DataFrame:
    """All metrics per group from one cumulative table: ranking, and operating at the cut."""
    flagged = F.col("score") >= cut
    rank = dict(zip(METRICS[:2], ranking.ranking_columns()))
    counted = cumulative.groupBy(*by).agg(
        *[m.alias(n) for n, m in rank.items()],
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("n_tp"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("n_fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("pos"))).alias("n_fn"),
        F.sum(F.when(flagged, 0).otherwise(F.col("neg"))).alias("n_tn"),
    )
    operating = threshold.operating_metrics(beta)
    return counted.select(*by, *rank, *[m.alias(n) for n, m in operating.items()])


def fixed_cut_metrics(scored: DataFrame, score: str, y: str | Column, cut: float = 0.5) -> DataFrame:
    """Ranking metrics with F1 and recall at a fixed cut: one row, as logged by training."""
    cumulative = ranking.cumulative_counts(scored, score, y)
    return metrics_at(cumulative, cut).select("roc_auc", "average_precision", "f1", "recall")


def choose_threshold(
    scored: DataFrame, score: str, y: str | Column, spec: EvalSpec, label: LabelSpec | None = None
) -> DataFrame:
    """Threshold choice from validation rows only."""
    validation = scored.where(F.col("split") == VALIDATION)
    return threshold.select_threshold(
        threshold.threshold_sweep(validation, score, y, spec), spec, label
    )


def evaluation_summary(
    scored: DataFrame,
    score: str,
    y: str | Column,
    spec: EvalSpec = EvalSpec(),
    label: LabelSpec | None = None,
    chosen: DataFrame | None = None,
    cumulative: DataFrame | None = None,
) -> DataFrame:
    """(split, metric, value): ranking metrics, and operating metrics at the frozen cut.

    ``chosen`` and ``cumulative`` are what this would compute, for callers that have them already.
    """
    held_out = scored.where(F.col("split").isin(VALIDATION, TEST))
    if chosen is None:
        chosen = choose_threshold(held_out, score, y, spec, label)
    cut = chosen.select("threshold").scalar()
    if cumulative is None:
        cumulative = ranking.cumulative_counts(held_out, score, y, ["split"])
    wide = metrics_at(cumulative, cut, spec.beta, ["split"])
    picked = chosen.select(
        F.lit(VALIDATION).alias("split"),
        F.lit("threshold").alias("metric"),
        F.col("threshold").alias("value"),
    )
    return wide.unpivot("split", list(METRICS), "metric", "value").unionByName(picked)
