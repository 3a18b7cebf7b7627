"""Validation counts and drift per event-time window, on streams and on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.functions.pvalues import chi2_p_values
from holdfast.operators.quality import Check


def window_failures(
    rows: DataFrame, ts: str, width: str, checks: Sequence[Check], watermark: str | None = None
) -> DataFrame:
    """Rows and failures of every check per tumbling window; the same for stream and table.

    The state of a stream is one counter row per open window.
    """
    if watermark is not None:
        rows = rows.withWatermark(ts, watermark)
    counted = rows.groupBy(F.window(ts, width).alias("w")).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(c.broken).alias(f"{c.rule}_{c.column}") for c in checks],
    )
    names = [f"{c.rule}_{c.column}" for c in checks]
    return counted.select(F.col("w.start").alias("window_start"), "n_rows", *names)


def _upsert(
    counted: DataFrame, output: str, checkpoint: str, available_now: bool
) -> StreamingQuery:
    """Append each batch's changed counts with the batch number, under a folder per batch."""

    def append(batch: DataFrame, batch_id: int) -> None:
        stamped = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        stamped.write.mode("overwrite").parquet(f"{output}/part={batch_id}")

    writer = (
        counted.writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def compact(written: DataFrame, output: str, keys: Sequence[str]) -> DataFrame:
    """Write the newest row of each window once, to a new place that replaces the old folders.

    Run it between runs of a stream (with a new ``output`` for the next one, and both read), so that
    the folders of old batches need not be kept or read for ever.
    """
    values = [c for c in written.columns if c not in (*keys, "batch", "part")]
    newest = F.max_by(F.struct(*values, "batch"), "batch").alias("v")
    kept = written.groupBy(*keys).agg(newest).select(*keys, "v.*")
    kept.write.mode("errorifexists").parquet(output)
    return written.sparkSession.read.schema(kept.schema).parquet(output)


def validate_stream(
    rows: DataFrame,
    ts: str,
    width: str,
    checks: Sequence[Check],
    *,
    output: str,
    checkpoint: str,
    watermark: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Keep a table of window counts up to date: changed windows are appended with their batch.

    ``latest_windows`` reads the newest row of each window back; ``compact`` folds old batches.
    """
    return _upsert(window_failures(rows, ts, width, checks, watermark), output, checkpoint, available_now)


def latest_windows(written: DataFrame) -> DataFrame:
    """Newest row of every window: counts only grow, and later batches replace earlier ones."""
    values = [c for c in written.columns if c not in ("window_start", "batch", "part")]
    newest = F.max_by(F.struct(*values), "batch").alias("v")
    return written.groupBy("window_start").agg(newest).select(
        "window_start", *[f"v.{c}" for c in values]
    )


def window_category_counts(
    rows: DataFrame, ts: str, width: str, columns: Sequence[str], missing: str = "__NA__"
) -> DataFrame:
    """(window_start, column, value, n) in one pass over all categorical columns.

    Grouped by the window itself, which carries the watermark: a stream frees the counters of a
    window once it has passed, and leaves out rows that come later.
    """
    values = [
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("value"))
        for c in columns
    ]
    long = rows.select(ts, F.explode(F.array(*values)).alias("cell"))
    counted = long.groupBy(
        F.window(ts, width).alias("w"),
        F.col("cell.column").alias("column"),
        F.col("cell.value").alias("value"),
    ).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "column", "value", "n")


def drift_windows(
    counts: DataFrame, reference: DataFrame, alpha: float = 0.05
) -> DataFrame:
    """Chi-square of every window against fixed reference counts (column, value, n).

    ``counts`` and ``reference`` hold one row per category, not per data row. A category of
    either side that the other lacks counts as 0.

    Categories that a window lacks are never listed: without any of its own, a category adds its
    reference count times (all of the window / all of the reference), so together they add what is
    left of the reference. Only with two categories in all (one degree of freedom) is the single
    absent one computed by itself, drawn in by one half like the other.
    """
    by = ["window_start", "column"]
    totals = reference.groupBy("column").agg(
        F.sum("n").cast("double").alias("all_ref"), F.count("*").alias("k_ref")
    )
    seen = counts.join(reference.withColumnRenamed("n", "n_ref"), ["column", "value"], "left")
    seen = seen.withColumn("r", F.coalesce("n_ref", F.lit(0)).cast("double"))
    sums = seen.groupBy(*by).agg(
        F.sum("n").cast("double").alias("all_cur"),
        F.sum("r").alias("ref_seen"),
        F.count_if(F.col("n_ref").isNull()).alias("only_cur"),
        F.count("n_ref").alias("in_both"),
    )
    # One row per compared column.
    sums = sums.join(F.broadcast(totals), "column", "left").select(
        *by, "all_cur",
        F.coalesce("all_ref", F.lit(0.0)).alias("all_ref"),
        (F.coalesce("all_ref", F.lit(0.0)) - F.col("ref_seen")).alias("ref_absent"),
        (F.coalesce("k_ref", F.lit(0)) - F.col("in_both")).alias("k_absent"),
        (F.coalesce("k_ref", F.lit(0)) + F.col("only_cur")).alias("n_values"),
    )

    def terms(ref: Column, cur: Column) -> Column:
        """What a category adds, drawn in by one half with one degree of freedom."""
        everything = F.col("all_ref") + F.col("all_cur")
        total: Column = F.lit(0.0)
        for own, all_ in ((ref, "all_ref"), (cur, "all_cur")):
            expected = F.try_divide((ref + cur) * F.col(all_), everything)
            gap = F.abs(own - expected)
            pull = F.when(F.col("n_values") == 2, F.least(F.lit(0.5), gap)).otherwise(F.lit(0.0))
            total = total + F.try_divide((gap - pull) * (gap - pull), expected)
        return total

    joined = seen.join(sums, by)
    absent = F.when(F.col("k_absent") == 0, F.lit(0.0)).when(
        F.col("n_values") == 2, terms(F.col("ref_absent"), F.lit(0.0))
    ).otherwise(F.try_divide(F.col("ref_absent") * F.col("all_cur"), F.col("all_ref")))
    own = terms(F.col("r"), F.col("n").cast("double"))
    added = joined.groupBy(*by).agg(
        F.max("n_values").alias("n_values"),
        F.max("all_ref").cast("long").alias("n_ref"),
        F.max("all_cur").cast("long").alias("n_cur"),
        (F.sum(own) + F.max(absent)).alias("chi2"),
    )
    usable = (F.col("n_values") >= 2) & (F.least("n_ref", "n_cur") > 0)
    tested = added.select(
        *by, "n_values", "n_ref", "n_cur",
        (F.col("n_values") - 1).alias("dof"),
        F.when(usable, F.col("chi2")).alias("statistic"),
    ).withColumn("p_value", chi2_p_values("statistic", "dof"))
    flag: Column = F.coalesce(F.col("p_value") < F.lit(float(alpha)), F.lit(False))
    return tested.withColumn("drift_flag", flag)


def drift_stream(
    rows: DataFrame,
    ts: str,
    width: str,
    columns: Sequence[str],
    *,
    output: str,
    checkpoint: str,
    watermark: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Window category counts of a stream, appended per batch with the batch number.

    The state is one counter per open window and category. Read the written counts with
    ``latest_counts`` and test them with ``drift_windows`` against fixed reference counts.
    """
    counted = window_category_counts(rows.withWatermark(ts, watermark), ts, width, columns)
    return _upsert(counted, output, checkpoint, available_now)


def latest_counts(written: DataFrame) -> DataFrame:
    """Newest count of every window and category."""
    return written.groupBy("window_start", "column", "value").agg(F.max("n").alias("n"))
