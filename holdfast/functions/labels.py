"""Label encodings and thresholding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.functions.repair import as_column
from holdfast.spec import LabelSpec


def label_binary(label: LabelSpec) -> Column:
    """1 for the positive label, 0 for anything else, missing included."""
    return F.coalesce(F.col(label.column) == label.positive, F.lit(False)).cast("int")


def label_ternary(label: LabelSpec) -> Column:
    """1 for the positive label, 0 for the negative one, null otherwise."""
    column = F.col(label.column)
    return F.when(column == label.positive, 1).when(column == label.negative, 0)


def apply_threshold(score: str | Column, threshold: float | Column, label: LabelSpec) -> Column:
    """Positive label where the score reaches the threshold."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(as_column(score) >= cut, F.lit(label.positive)).otherwise(F.lit(label.negative))
