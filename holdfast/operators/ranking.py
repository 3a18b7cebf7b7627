"""Threshold-free ranking metrics and curves from one cumulative table per split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.repair import as_column, required_score
from holdfast.operators.running import ValueRanges, measure_ranges, running_totals


def score_counts(scored: DataFrame, score: str, y: str | Column, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: one row per score, however often it occurs.

    A score that is null or NaN is an error (``required_score``).
    """
    return (
        scored.select(*by, required_score(F.col(score)).alias("score"), as_column(y).alias("_y"))
        .groupBy(*by, "score")
        .agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    )


def cumulative_counts(
    scored: DataFrame,
    score: str,
    y: str | Column,
    by: Sequence[str] = (),
    ranges: ValueRanges | None = None,
) -> DataFrame:
    """Per distinct score, from the highest down: running and total positives and negatives."""
    if ranges is None:
        ranges = measure_ranges(scored, score, by)
    counts = score_counts(scored, score, y, by)
    return running_totals(counts, "score", ["pos", "neg"], ranges, by, descending=True)


def _area() -> Column:
    """Share of positive-negative pairs in the right order, ties counted half."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("cum_pos").cast("double") - pos
    pairs = F.sum(pos) * F.sum(neg)
    return F.try_divide(F.sum(neg * above + neg * pos / 2.0), pairs)


def _average_precision() -> Column:
    """Precision at every distinct score, weighted by the positives found there."""
    pos = F.col("pos").cast("double")
    found = F.col("cum_pos").cast("double")
    flagged = found + F.col("cum_neg").cast("double")
    return F.try_divide(F.sum(F.try_divide(pos * found, flagged)), F.sum(pos))


def ranking_columns() -> tuple[Column, Column]:
    """Aggregates over a cumulative table: ROC-AUC, average precision; null without both classes."""
    return _area(), _average_precision()


def ranking_metrics(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    area, precision = ranking_columns()
    return cumulative.groupBy(*by).agg(
        area.alias("roc_auc"), precision.alias("average_precision")
    )


def _with_end(
    curve: DataFrame, cumulative: DataFrame, by: Sequence[str], x: str, y: str, y_at_end: float, at: float | None
) -> DataFrame:
    """The curve and the point where nothing is flagged, once for each group."""
    ends = cumulative.groupBy(*by).agg(F.lit(0.0).alias(x), F.lit(y_at_end).alias(y))
    return curve.unionByName(ends.withColumn("threshold", F.lit(at).cast("double")))


def roc_curve(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, and the start (0, 0) at an infinite cut."""
    curve = cumulative.select(
        *by,
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    return _with_end(curve, cumulative, by, "fpr", "tpr", 0.0, float("inf"))


def pr_curve(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(recall, precision, threshold) at every distinct score, and the end (0, 1) without a cut."""
    curve = cumulative.select(
        *by,
        F.try_divide("cum_pos", "all_pos").alias("recall"),
        F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.col("score").alias("threshold"),
    )
    return _with_end(curve, cumulative, by, "recall", "precision", 1.0, None)
