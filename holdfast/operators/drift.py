"""Two-sample drift: Kolmogorov-Smirnov for numbers, chi-square for categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import workspace
from holdfast.functions import repair
from holdfast.functions.pvalues import chi2_p_values, ks_p_values
from holdfast.operators.running import ONE_RANGE_ROWS, measure_ranges, running_totals
from holdfast.spec import ModelingSpec

#: Text that stands for a missing category (fixed value).
MISSING = "__NA__"

# Notes that readers of a report match on.
NOTE_FEW = "too few non-null values"
NOTE_SINGLE = "single category after NA fill"
NOTE_EMPTY = "empty split for contingency"
NOTE_ABSENT = "column missing in one frame"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("column", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("statistic", T.DoubleType()),
        T.StructField("p_value", T.DoubleType()),
        T.StructField("drift_flag", T.BooleanType(), False),
        T.StructField("note", T.StringType()),
    ]
)


def _both(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], read
) -> DataFrame:
    """Rows of both tables as (is_cur, column, value)."""
    def side(df: DataFrame, is_cur: int) -> DataFrame:
        return df.select(F.lit(is_cur).alias("is_cur"), *[read(df, c).alias(c) for c in columns])

    rows = side(reference, 0).unionByName(side(current, 1))
    return rows.unpivot("is_cur", list(columns), "column", "value")


def numeric_values(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null numbers of both tables as (is_cur, column, value)."""
    long = _both(reference, current, columns, repair.to_number)
    return long.where(F.col("value").isNotNull())


def category_or_missing(column: str | Column) -> Column:
    """Category as text, missing replaced by its sentinel."""
    return F.coalesce(repair.as_column(column).cast("string"), F.lit(MISSING))


def contingency(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n_ref, n_cur) for several categorical columns in one pass."""
    long = _both(reference, current, columns, lambda df, c: category_or_missing(c))
    return long.groupBy("column", "value").agg(
        F.sum(1 - F.col("is_cur")).alias("n_ref"), F.sum("is_cur").alias("n_cur")
    )


def _written(counts: DataFrame, name: str) -> DataFrame:
    """Counts as a table: what is computed from them reads it, not the data again."""
    path = workspace.new_path(counts.sparkSession, name)
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def ks_statistics(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    one_range_rows: int = ONE_RANGE_ROWS,
) -> DataFrame:
    """(column, n_ref, n_cur, statistic): largest gap between the two distributions.

    Each table is read once: values are counted per side and the counts written, so a value that
    fills a third of the rows is one counted row; then running totals, over ranges of at most about
    ``one_range_rows`` distinct values, give both distributions at every value.
    """
    long = numeric_values(reference, current, columns)
    counts = _written(
        long.groupBy("column", "value").agg(
            F.sum(1 - F.col("is_cur")).alias("ref"), F.sum("is_cur").alias("cur")
        ),
        "numbers",
    )
    ranges = measure_ranges(counts, "value", ["column"], one_range_rows=one_range_rows)
    running = running_totals(counts, "value", ["ref", "cur"], ranges, ["column"])
    gap = F.abs(
        F.try_divide("cum_ref", "all_ref") - F.try_divide("cum_cur", "all_cur")
    )
    found = running.groupBy("column").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.max(gap).alias("gap")
    )
    enough = (F.col("n_ref") >= 2) & (F.col("n_cur") >= 2)
    return found.select("column", "n_ref", "n_cur", F.when(enough, F.col("gap")).alias("statistic"))


def chi2_from_counts(
    counts: DataFrame, by: Sequence[str] = ("column",), few_groups: bool = True
) -> DataFrame:
    """(by, n_values, n_ref, n_cur, dof, statistic) from (by, value, n_ref, n_cur) counts.

    With one degree of freedom every gap is drawn in by up to one half (Yates).
    ``few_groups``: there is one group per compared column, so the group totals may be broadcast.
    """
    by = list(by)
    totals = counts.groupBy(*by).agg(
        F.count("*").alias("n_values"),
        F.sum("n_ref").cast("double").alias("all_ref"),
        F.sum("n_cur").cast("double").alias("all_cur"),
    )
    joined = counts.join(F.broadcast(totals) if few_groups else totals, by)
    share = (F.col("n_ref") + F.col("n_cur")) / (F.col("all_ref") + F.col("all_cur"))

    def term(seen: str, all_: str) -> Column:
        expected = share * F.col(all_)
        gap = F.abs(F.col(seen) - expected)
        pull = F.when(F.col("n_values") == 2, F.least(F.lit(0.5), gap)).otherwise(F.lit(0.0))
        return F.try_divide((gap - pull) * (gap - pull), expected)

    usable = (F.col("n_values") >= 2) & (F.least("n_ref", "n_cur") > 0)
    return (
        joined.groupBy(*by)
        .agg(
            F.max("n_values").alias("n_values"),
            F.max("all_ref").cast("long").alias("n_ref"),
            F.max("all_cur").cast("long").alias("n_cur"),
            F.sum(term("n_ref", "all_ref") + term("n_cur", "all_cur")).alias("chi2"),
        )
        .select(
            *by, "n_values", "n_ref", "n_cur",
            (F.col("n_values") - 1).alias("dof"),
            F.when(usable, F.col("chi2")).alias("statistic"),
        )
    )


def chi2_statistics(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    return chi2_from_counts(_written(contingency(reference, current, columns), "categories"))


def _flagged(alpha: float) -> Column:
    return F.coalesce(F.col("p_value") < F.lit(float(alpha)), F.lit(False))


def _fixed_rows(reference: DataFrame, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    spark = reference.sparkSession
    listed = [(c, kind, None, None, False, note) for c, kind, note in rows]
    return spark.createDataFrame(listed, REPORT_SCHEMA)


def drift_report(
    reference: DataFrame, current: DataFrame, spec: ModelingSpec, alpha: float = 0.05
) -> DataFrame:
    """(column, kind, statistic, p_value, drift_flag, note) for every modeling column.

    A column absent from either table, too short, or of a single category gets a note and no
    statistic.
    """
    both = set(reference.columns) & set(current.columns)
    numbers = [c for c in spec.numeric if c in both]
    texts = [c for c in spec.categorical if c in both]
    absent = [(c, "numeric", NOTE_ABSENT) for c in spec.numeric if c not in both]
    absent += [(c, "categorical", NOTE_ABSENT) for c in spec.categorical if c not in both]
    parts = []
    if numbers:
        found = ks_statistics(reference, current, numbers)
        # The statistics hold one row per compared column; a column without any value on
        # either side has none and comes back through the list of names.
        ks = (
            literal_names(reference, numbers)
            .join(F.broadcast(found), "column", "left")
            .withColumn("p_value", ks_p_values("statistic", "n_ref", "n_cur"))
        )
        note = F.when(F.col("statistic").isNull(), F.lit(NOTE_FEW))
        parts.append(
            ks.select(
                "column", F.lit("numeric").alias("kind"), "statistic", "p_value",
                _flagged(alpha).alias("drift_flag"), note.alias("note"),
            )
        )
    if texts:
        # As above: columns of two empty tables have no counts and come back by name.
        chi2 = literal_names(reference, texts).join(
            F.broadcast(chi2_statistics(reference, current, texts)), "column", "left"
        ).withColumn("p_value", chi2_p_values("statistic", "dof"))
        note = F.when(F.coalesce("n_values", F.lit(0)) < 2, F.lit(NOTE_SINGLE)).when(
            F.col("statistic").isNull(), F.lit(NOTE_EMPTY)
        )
        parts.append(
            chi2.select(
                "column", F.lit("categorical").alias("kind"), "statistic", "p_value",
                _flagged(alpha).alias("drift_flag"), note.alias("note"),
            )
        )
    if absent:
        parts.append(_fixed_rows(reference, absent))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def literal_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    listed = F.explode(F.array(*[F.lit(n) for n in names])).alias("column")
    return df.sparkSession.range(1).select(listed)


def flagged_columns(report: DataFrame) -> DataFrame:
    """How many columns of a report are flagged."""
    return report.agg(F.count_if("drift_flag").alias("n_columns_flagged"))


def missing_rates(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of missing values per column on both sides, which the KS test does not see."""
    def rates(df: DataFrame, name: str) -> DataFrame:
        wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
        return wide.unpivot([], list(columns), "column", name)

    return rates(reference, "ref_missing").join(rates(current, "cur_missing"), "column")
