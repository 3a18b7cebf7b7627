"""From probabilities to the scored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.labels import apply_threshold
from holdfast.operators.training import SCORE
from holdfast.spec import ModelingSpec

PREDICTED, ACTUAL = "predicted_churn", "actual_churn"


def has_labels(df: DataFrame, spec: ModelingSpec) -> bool:
    """Whether any row carries a label: looks for one, never counts."""
    column = spec.label.column
    if column not in df.columns:
        return False
    return not df.where(F.col(column).isNotNull()).select(column).limit(1).isEmpty()


def score_projection(
    scored: DataFrame, spec: ModelingSpec, threshold: float, score: str = SCORE,
    with_actual: bool | None = None,
) -> DataFrame:
    """Id, probability, predicted label, and the actual label when the input has any.

    ``with_actual`` skips the look at the data, as a stream must.
    """
    if with_actual is None:
        with_actual = has_labels(scored, spec)
    actual = [F.col(spec.label.column).alias(ACTUAL)] if with_actual else []
    return scored.select(
        spec.id_column,
        F.col(score).alias(SCORE),
        apply_threshold(score, threshold, spec.label).alias(PREDICTED),
        *actual,
    )


def scored_vs_actual(scores: DataFrame, labels: DataFrame, spec: ModelingSpec) -> DataFrame:
    """Rows per predicted and actual label, for labels that arrive after scoring."""
    actual = labels.select(spec.id_column, F.col(spec.label.column).alias(ACTUAL))
    joined = scores.drop(ACTUAL).join(actual, spec.id_column, "left")
    return joined.groupBy(PREDICTED, ACTUAL).agg(F.count("*").alias("n_rows"))
