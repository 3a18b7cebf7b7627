"""Column statistics that merge: one row of sketches per input part and column.

Sketches of new parts are added to a table; the statistics of all parts come from merging its rows,
so no part is read again. A part that is sketched again replaces its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch: 2.5 times the default, some 10 KB a row at most.
QUANTILE_SIZE = 500
#: Places of a distinct sketch, as a power of two: 4 KB a row at most.
DISTINCT_BITS = 12


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Bound on a quantile's rank, as a share of the rows, that holds in 99 of 100 sketches."""
    return 2.296 / size**0.9021  # fixed values: the published fit for this kind of sketch


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Three standard errors of a distinct count, as a share of it."""
    return 3 * 1.04 / 2 ** (bits / 2)


def sketch_parts(
    df: DataFrame,
    part: Column,
    numeric: Sequence[str],
    text: Sequence[str] = (),
    size: int = QUANTILE_SIZE,
    bits: int = DISTINCT_BITS,
) -> DataFrame:
    """(part, column, n_rows, n_missing, smallest, largest, quantiles, distinct) in one pass.

    part: text that names the input part of a row; a null part is its own (``none``). Nulls and NaN
    are missing; smallest, largest and quantiles are null for text columns and for columns of a part without a number.
    Partial sketches are merged before the shuffle, so a part that holds most rows is no hot key.
    """
    both = set(numeric) & set(text)
    if both:
        raise ValueError(f"columns named as numbers and as text: {sorted(both)}")

    def cell(name: str, is_number: bool) -> Column:
        number = F.col(f"`{name}`").cast("double") if is_number else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number + F.lit(0.0))  # -0.0 is 0.0
        value = number.cast("string") if is_number else F.col(f"`{name}`").cast("string")
        return F.struct(F.lit(name).alias("column"), number.alias("number"), value.alias("value"))

    cells = [cell(c, True) for c in numeric] + [cell(c, False) for c in text]
    named = F.coalesce(part.cast("string"), F.lit("none"))
    long = df.select(named.alias("part"), F.inline(F.array(*cells)))
    return long.groupBy("part", "column").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.min("number").alias("smallest"),
        F.max("number").alias("largest"),
        F.when(F.count("number") > 0, F.kll_sketch_agg_double("number", size)).alias("quantiles"),
        F.hll_sketch_agg("value", bits).alias("distinct"),
    )


def add_parts(sketches: DataFrame, path: str) -> DataFrame:
    """Add the rows of some parts to the table at a path, in place of earlier rows of the same parts.

    Parts must be written whole: a part's rows come from all of its data.
    """
    writer = sketches.write.mode("overwrite").partitionBy("part")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return sketches.sparkSession.read.schema(sketches.schema).parquet(path)


def summarize(sketches: DataFrame, share: float = 0.5) -> DataFrame:
    """(column, n_rows, n_missing, smallest, largest, quantile, n_distinct) of all parts together.

    Counts, smallest and largest are exact. The quantile's rank is within ``rank_error`` of
    ``share`` (of a part with fewer rows than the sketch's size it is exact); n_distinct is within
    ``distinct_error``, without the missing.
    """
    merged = sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_missing").alias("n_missing"),
        F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"),
        F.count("quantiles").alias("n_sketches"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    )
    quantile = F.kll_sketch_get_quantile_double("quantiles", F.lit(float(share)))
    return merged.select(
        "column", "n_rows", "n_missing", "smallest", "largest",
        F.when(F.col("n_sketches") > 0, quantile).alias("quantile"),
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
    )


def rank_gap(df: DataFrame, estimates: DataFrame, numeric: Sequence[str], share: float = 0.5) -> DataFrame:
    """(column, gap): how far the share of rows up to an estimate is from ``share``, counted exactly.

    A value stands for all ranks of its copies, so the gap is 0 if ``share`` lies among them. One
    pass over the table; one estimate per column.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("number")) for c in numeric]
    long = df.select(F.inline(F.array(*cells))).where(F.col("number").isNotNull() & ~F.isnan("number"))
    met = long.join(F.broadcast(estimates.select("column", "quantile")), "column")  # a row per column
    counted = met.groupBy("column").agg(
        F.count_if(F.col("number") < F.col("quantile")).alias("below"),
        F.count_if(F.col("number") <= F.col("quantile")).alias("upto"),
        F.count("*").alias("n"),
    )
    low = F.col("below") / F.col("n") - F.lit(share)
    high = F.lit(share) - F.col("upto") / F.col("n")
    return counted.select("column", F.greatest(low, high, F.lit(0.0)).alias("gap"))
