"""Data-quality rules: one pass over the table gives one row per rule and column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.contracts import ColumnRule
from holdfast.functions import repair
from holdfast.functions.labels import label_binary
from holdfast.spec import ModelingSpec


class ValidationError(ValueError):
    """A table breaks its rules."""


@dataclass(frozen=True)
class Check:
    """One rule on one column: rows where ``broken`` holds fail."""

    rule: str
    column: str
    broken: Column


def column_differences(
    columns: Iterable[str], rules: Sequence[ColumnRule]
) -> list[tuple[str, str]]:
    """(rule, column) pairs for columns that are missing or not expected."""
    have, want = list(columns), [r.name for r in rules]
    missing = [("column_missing", c) for c in want if c not in have]
    extra = [("column_unexpected", c) for c in have if c not in want]
    return missing + extra


def _fits(df: DataFrame, rule: ColumnRule) -> Column | None:
    """Broken-type test: text must read as the wanted type, other types must be that type."""
    have = df.schema[rule.name].dataType
    if isinstance(rule.type, T.StringType):
        return None if isinstance(have, T.StringType) else F.col(rule.name).isNotNull()
    if isinstance(have, T.StringType):
        text = repair.stripped(rule.name)
        if isinstance(rule.type, T.IntegralType):
            return F.col(rule.name).isNotNull() & ~text.rlike(repair.WHOLE_TEXT)
        return F.col(rule.name).isNotNull() & ~text.rlike(repair.READABLE_TEXT)
    if isinstance(rule.type, T.IntegralType):
        whole = isinstance(have, T.IntegralType)
        return None if whole else F.col(rule.name).isNotNull()
    real = isinstance(have, (T.DoubleType, T.FloatType))
    return None if real else F.col(rule.name).isNotNull()


def type_checks(df: DataFrame, rules: Sequence[ColumnRule]) -> list[Check]:
    """Values that do not have the column's type; nothing is converted."""
    out = []
    for r in rules:
        if r.name not in df.columns:
            continue
        broken = _fits(df, r)
        out.append(Check("type", r.name, F.lit(False) if broken is None else broken))
    return out


def null_checks(df: DataFrame, rules: Sequence[ColumnRule]) -> list[Check]:
    return [
        Check("not_null", r.name, F.col(r.name).isNull())
        for r in rules
        if not r.nullable and r.name in df.columns
    ]


def domain_checks(df: DataFrame, rules: Sequence[ColumnRule]) -> list[Check]:
    """Values outside the allowed list; a null is not a domain failure."""
    out = []
    for r in rules:
        if not r.domain or r.name not in df.columns:
            continue
        if all(isinstance(v, (int, float)) for v in r.domain):
            value = repair.to_number(df, r.name)
            allowed = [float(v) for v in r.domain]
        else:
            value, allowed = F.col(r.name).cast("string"), list(r.domain)
        out.append(Check("domain", r.name, value.isNotNull() & ~value.isin(allowed)))
    return out


def range_checks(df: DataFrame, rules: Sequence[ColumnRule]) -> list[Check]:
    return [
        Check("minimum", r.name, repair.to_number(df, r.name) < F.lit(float(r.minimum)))
        for r in rules
        if r.minimum is not None and r.name in df.columns
    ]


def rule_checks(df: DataFrame, rules: Sequence[ColumnRule]) -> list[Check]:
    return [
        *type_checks(df, rules),
        *null_checks(df, rules),
        *domain_checks(df, rules),
        *range_checks(df, rules),
    ]


def count_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(rule, column, n_failed, sample_value) for every check, counted in one pass.

    The sample is the smallest failing value as text, so it does not depend on row order.
    """
    # Every test is evaluated once per row, then counted and sampled from.
    tested = df.select(
        *[c.broken.alias(f"_b{i}") for i, c in enumerate(checks)],
        *[F.col(c).cast("string").alias(f"_v_{c}") for c in sorted({c.column for c in checks})],
    )
    one_pass = tested.agg(
        *[F.count_if(f"_b{i}").alias(f"n{i}") for i in range(len(checks))],
        *[F.min(F.when(F.col(f"_b{i}"), F.col(f"_v_{c.column}"))).alias(f"s{i}")
          for i, c in enumerate(checks)],
    )
    facts = F.array(
        *[
            F.struct(
                F.lit(c.rule).alias("rule"),
                F.lit(c.column).alias("column"),
                F.col(f"n{i}").alias("n_failed"),
                F.col(f"s{i}").alias("sample_value"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return one_pass.select(F.inline(facts))


def violations(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Broken rules only: column set, types, nulls, domains and ranges."""
    counted = count_failures(df, rule_checks(df, rules)).where(F.col("n_failed") > 0)
    for rule, column in column_differences(df.columns, rules):
        row = df.sparkSession.range(1).select(
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column"),
            F.lit(1).cast("long").alias("n_failed"),
            F.lit(None).cast("string").alias("sample_value"),
        )
        counted = counted.unionByName(row)
    return counted


def assert_valid(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """The table itself when it keeps every rule; otherwise ValidationError naming the breaks."""
    differing = column_differences(df.columns, rules)
    if differing:
        raise ValidationError("; ".join(f"{r}: {c}" for r, c in differing))
    broken = violations(df, rules).collect()  # at most one row per rule and column
    if broken:
        raise ValidationError(
            "; ".join(
                f"{b['rule']} on {b['column']}: {b['n_failed']} rows (such as {b['sample_value']!r})"
                for b in broken
            )
        )
    return df


def leakage_checks(df: DataFrame, spec: ModelingSpec) -> DataFrame:
    """Signs that a column gives the label away, and whether the id is unique.

    For every categorical column: its values, how many of them hold a single class, the share
    of rows that guessing each value's larger class gets right, and whether that is all of them.
    """
    y = label_binary(spec.label)
    ids = df.groupBy(spec.id_column).agg(F.count("*").alias("n"))
    id_row = ids.agg(
        F.count("*").alias("n_values"),
        F.sum((F.col("n") == 1).cast("long")).alias("n_pure"),
        F.round(F.count("*") / F.sum("n"), 6).alias("share"),
        (F.sum("n") == F.count("*")).alias("suspect"),
    ).select(
        F.lit("id_unique").alias("check"), F.lit(spec.id_column).alias("column"),
        "n_values", "n_pure", "share", "suspect",
    )
    text = [F.col(c).cast("string").alias(c) for c in spec.categorical]
    long = df.select(y.alias("_y"), *text).unpivot("_y", list(spec.categorical), "column", "value")
    per_value = long.groupBy("column", "value").agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg")
    )
    larger = F.greatest("pos", "neg")
    by_column = per_value.groupBy("column").agg(
        F.count("*").alias("n_values"),
        F.sum((F.least("pos", "neg") == 0).cast("long")).alias("n_pure"),
        F.round(F.sum(larger) / F.sum(F.col("pos") + F.col("neg")), 6).alias("share"),
        (F.sum(F.least("pos", "neg")) == 0).alias("suspect"),
    )
    columns = ["check", "column", "n_values", "n_pure", "share", "suspect"]
    return id_row.unionByName(
        by_column.withColumn("check", F.lit("label_determined")).select(*columns)
    )
