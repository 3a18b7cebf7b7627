"""Window counts that leave no row out: late rows are counted too, and told apart.

Each batch of the stream is counted by window and written as rows that add up, so no state is held
and nothing is ever dropped. A row is late if its window had ended, for the batches before its own,
by more than the delay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.quality import Check

COUNTS, COMMITS = "counts", "commits"


def _newest(spark: SparkSession, path: str, before: int) -> int | None:
    """The latest event time, in microseconds, of the batches before one; None if there is none."""
    try:
        commits = spark.read.schema("newest long, batch long").parquet(f"{path}/{COMMITS}")
    except AnalysisException:
        return None
    return commits.where(F.col("batch") < before).agg(F.max("newest")).first()[0]


def count_stream(
    rows: DataFrame,
    ts: str,
    width: str,
    checks: Sequence[Check],
    *,
    path: str,
    checkpoint: str,
    delay: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that keeps counts of every check per window under ``path``, late rows apart.

    A batch writes its counts, one row per window of its rows and lateness, and last a commit with its
    latest event time, each to a folder named by the batch: a batch that is replayed after a crash
    replaces what it wrote, and sees only the commits before it, so it tells late rows as it did before. Rows
    without an event time belong to no window and are left out, as by ``window_failures``.
    ``delay`` is an interval such as ``1 hour``.
    """
    names = [f"{c.rule}_{c.column}" for c in checks]

    def write(batch: DataFrame, number: int) -> None:
        newest = F.lit(_newest(batch.sparkSession, path, number)).cast("long")
        limit = F.timestamp_micros(newest) - F.expr(f"interval {delay}")
        counted = batch.where(F.col(ts).isNotNull()).groupBy(F.window(ts, width).alias("w")).agg(
            F.count("*").alias("n_rows"),
            *[F.count_if(c.broken).alias(n) for c, n in zip(checks, names, strict=True)],
            F.unix_micros(F.max(ts)).alias("newest_row"),
        )
        counted = counted.select(
            F.col("w.start").alias("window_start"),
            F.coalesce(F.col("w.end") <= limit, F.lit(False)).alias("late"),
            "n_rows", *names, "newest_row",
        )
        at = f"{path}/{COUNTS}/batch={number}"
        counted.write.mode("overwrite").parquet(at)
        written = batch.sparkSession.read.schema(counted.schema).parquet(at)
        latest = written.agg(F.max("newest_row").alias("newest"))
        latest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{COMMITS}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def counts(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, late, n_rows, a count per check) of the batches that were written whole."""
    written = spark.read.parquet(f"{path}/{COUNTS}")
    commits = spark.read.parquet(f"{path}/{COMMITS}").select("batch")
    whole = written.join(commits, "batch", "left_semi")
    values = [c for c in written.columns if c not in ("window_start", "late", "newest_row", "batch")]
    return whole.groupBy("window_start", "late").agg(*[F.sum(c).alias(c) for c in values])


def with_late(counted: DataFrame) -> DataFrame:
    """One row per window: all of its counts, as the table would give them, and n_late of its rows."""
    values = [c for c in counted.columns if c not in ("window_start", "late")]
    late: Column = F.sum(F.when(F.col("late"), F.col("n_rows")).otherwise(0))
    return counted.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in values], late.alias("n_late"))


def fold(spark: SparkSession, path: str, output: str) -> DataFrame:
    """The counts so far as one small table in a new place, so that old batches need not be read for ever.

    Run it between runs of a stream; the next run gets a new ``path``, and both tables are read together
    by adding them up. Late rows of the next run are told by its own batches alone.
    """
    folded = counts(spark, path)
    folded.write.mode("errorifexists").parquet(output)
    return spark.read.schema(folded.schema).parquet(output)
