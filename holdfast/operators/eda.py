"""Exploratory summary of a snapshot table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions import repair
from holdfast.functions.labels import label_binary, label_ternary
from holdfast.spec import LabelSpec

TOP_MISSING = 15
TOP_CORRELATIONS = 15
TOP_CARDINALITIES = 20


def text_columns(df: DataFrame, label: LabelSpec) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name != label.column
    ]


def number_columns(df: DataFrame, label: LabelSpec) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name != label.column
    ]


def table_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and the columns in order."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def label_counts(df: DataFrame, label: LabelSpec) -> DataFrame:
    """Rows per label value; missing is a value of its own."""
    return df.groupBy(label.column).agg(F.count("*").alias("n_rows"))


def positive_rate(df: DataFrame, label: LabelSpec) -> DataFrame:
    """Share of positive rows in percent, over all rows, 3 digits."""
    return df.agg(F.round(F.avg(label_binary(label)) * 100, 3).alias("positive_rate_pct"))


def class_distribution(df: DataFrame, label: LabelSpec) -> DataFrame:
    """Count and percent of all rows for the two label values, in fixed order; 0 when absent."""
    values = (label.negative, label.positive)
    counted = df.agg(
        F.count("*").alias("n_all"),
        *[F.count_if(F.col(label.column) == v).alias(f"n{i}") for i, v in enumerate(values)],
    )
    facts = F.array(
        *[
            F.struct(F.lit(v).alias("label"), F.col(f"n{i}").alias("n_rows"))
            for i, v in enumerate(values)
        ]
    )
    return counted.select("n_all", F.inline(facts)).select(
        "label",
        "n_rows",
        F.round(F.try_divide(F.col("n_rows") * 100, F.col("n_all")), 3).alias("pct"),
    )


def _missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.col(column).isNull() | F.isnan(column)
    return F.col(column).isNull()


def missing_by_column(df: DataFrame) -> DataFrame:
    """Missing cells per column, count and percent (2 digits); columns without any left out."""
    one_pass = df.agg(
        F.count("*").alias("n_all"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    facts = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    return (
        one_pass.select("n_all", F.inline(facts))
        .where(F.col("missing_count") > 0)
        .select(
            "column",
            "missing_count",
            F.round(F.col("missing_count") * 100 / F.col("n_all"), 2).alias("missing_pct"),
        )
    )


def missing_topk(df: DataFrame, k: int = TOP_MISSING) -> DataFrame:
    """The k columns with most missing cells."""
    return missing_by_column(df).orderBy(F.desc("missing_count"), "column").limit(k)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) over several columns in one pass; missing is a value."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count("*").alias("n"))


def cardinality(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column, missing counted as one value."""
    if not approx:
        return value_counts(df, columns).groupBy("column").agg(F.count("*").alias("n_distinct"))
    one_pass = df.agg(
        *[
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c)
            for c in columns
        ]
    )
    return one_pass.unpivot([], list(columns), "column", "n_distinct")


def cardinality_topk(
    df: DataFrame, columns: Sequence[str], k: int = TOP_CARDINALITIES
) -> DataFrame:
    return cardinality(df, columns).orderBy(F.desc("n_distinct"), "column").limit(k)


def _moments(df: DataFrame, label: LabelSpec, columns: Sequence[str]) -> list[Column]:
    """Count, variances and covariance of each column with the label, on rows that have both."""
    y = label_ternary(label)
    out = []
    for i, c in enumerate(columns):
        x = repair.to_number(df, c)
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y.cast("double"))
        out += [
            F.count(xs).alias(f"n{i}"),
            F.var_pop(xs).alias(f"vx{i}"),
            F.var_pop(ys).alias(f"vy{i}"),
            F.covar_pop(xs, ys).alias(f"cv{i}"),
        ]
    return out


def _strongest(columns: Sequence[str], k: int) -> Column:
    """Array of (strength, column, correlation) from a row of moments: strongest k first."""
    def one(i: int, c: str) -> Column:
        n, vx, vy = F.col(f"n{i}"), F.col(f"vx{i}"), F.col(f"vy{i}")
        usable = (n >= 2) & (vx > 0) & (vy > 0)
        r = F.when(usable, F.try_divide(F.col(f"cv{i}"), F.sqrt(vx) * F.sqrt(vy)))
        return F.struct(
            (-F.abs(r)).alias("weakness"), F.lit(c).alias("column"), r.alias("correlation")
        )

    known = F.filter(
        F.array(*[one(i, c) for i, c in enumerate(columns)]),
        lambda s: s["correlation"].isNotNull(),
    )
    return F.slice(F.array_sort(known), 1, k)


def label_correlation(
    df: DataFrame, label: LabelSpec, columns: Sequence[str], k: int = TOP_CORRELATIONS
) -> DataFrame:
    """Pearson correlation of numeric columns with the 0/1 label, strongest k.

    Rows with either side missing are left out per column; a column with fewer than two such
    rows or without variance is skipped.
    """
    found = df.agg(*_moments(df, label, columns)).select(F.inline(_strongest(columns, k)))
    return found.select("column", "correlation")


def eda_summary(df: DataFrame, label: LabelSpec) -> DataFrame:
    """The whole summary as one tidy table (section, name, value), in two passes over the rows."""
    numbers, texts = number_columns(df, label), text_columns(df, label)

    def fact(section: str, name: str | Column, value: Column) -> Column:
        named = F.lit(name) if isinstance(name, str) else name
        return F.struct(
            F.lit(section).alias("section"),
            named.alias("name"),
            value.cast("double").alias("value"),
        )

    one_pass = df.agg(
        F.count("*").alias("n_all"),
        F.avg(label_binary(label)).alias("rate"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
        *_moments(df, label, numbers),
    )
    facts = [
        fact("shape", "n_rows", F.col("n_all")),
        fact("shape", "n_columns", F.lit(len(df.columns))),
        fact("positive_rate_pct", label.positive, F.round(F.col("rate") * 100, 3)),
    ]
    for i, c in enumerate(df.columns):
        n = F.when(F.col(f"m{i}") > 0, F.col(f"m{i}"))
        facts += [
            fact("missing_count", c, n),
            fact("missing_pct", c, F.round(n * 100 / F.col("n_all"), 2)),
        ]
    correlations = F.transform(
        _strongest(numbers, TOP_CORRELATIONS),
        lambda s: fact("label_correlation", s["column"], F.round(s["correlation"], 6)),
    )
    known = F.filter(F.array(*facts), lambda s: s["value"].isNotNull())
    wide = one_pass.select(F.inline(F.concat(known, correlations)))

    is_label = F.col("column") == label.column
    counted = value_counts(df, [label.column, *texts]).select(
        F.when(is_label, F.lit("label_count")).otherwise(F.lit("cardinality")).alias("section"),
        F.when(is_label, F.coalesce("value", F.lit("<missing>")))
        .otherwise(F.col("column"))
        .alias("name"),
        F.when(is_label, F.col("n")).otherwise(F.lit(1)).alias("n"),
    )
    narrow = counted.groupBy("section", "name").agg(F.sum("n").cast("double").alias("value"))
    return wide.unionByName(narrow)
