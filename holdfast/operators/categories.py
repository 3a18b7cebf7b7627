"""Category sets of two tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null (column, value) pairs of several text columns, in one pass."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct()


def category_union(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every category seen in either table."""
    return category_values(a, columns).union(category_values(b, columns)).distinct()


def unseen_categories(
    reference: DataFrame, current: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Categories of the current table that the reference never had: they encode to zeros."""
    return category_values(current, columns).join(
        category_values(reference, columns), ["column", "value"], "left_anti"
    )
