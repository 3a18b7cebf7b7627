"""Stream scoring in one pass: rows or JSON records in, scores and refused rows out, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators import row_rules, training
from holdfast.operators.scoring import score_projection
from holdfast.sources import records
from holdfast.spec import ModelingSpec

COMMITS = "commits"


def score_stream(
    rows: DataFrame,
    model: PipelineModel,
    spec: ModelingSpec,
    threshold: float,
    *,
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start one query over a streaming table of typed rows: scores and refused rows under ``path``.

    The source is read and ruled once. A batch writes its scores, its refused rows with their reasons,
    and last a commit with the numbers of both, each to a folder named by the batch: a batch that is
    replayed after a crash replaces what it wrote, and ``committed`` shows whole batches only.
    """
    with_actual = spec.label.column in rows.columns
    check = lambda batch: row_rules.check_rows(batch, spec)
    return _start(rows, check, model, spec, threshold, with_actual, path, checkpoint, available_now)


def score_record_stream(
    lines: DataFrame,
    model: PipelineModel,
    spec: ModelingSpec,
    threshold: float,
    *,
    path: str,
    checkpoint: str,
    text: str = "value",
    available_now: bool = True,
) -> StreamingQuery:
    """As ``score_stream``, over a streaming table of JSON texts, one record each.

    Records that cannot be read (broken, unknown fields, wrong types) are refused like rows that break
    a rule, with the text as it came in ``_record``. One bad record never stops the stream.
    """
    check = lambda batch: records.check_records(batch, spec, text)
    return _start(lines, check, model, spec, threshold, True, path, checkpoint, available_now)


def _start(
    source: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    model: PipelineModel,
    spec: ModelingSpec,
    threshold: float,
    with_actual: bool,
    path: str,
    checkpoint: str,
    available_now: bool,
) -> StreamingQuery:
    def write(batch: DataFrame, number: int) -> None:
        checked = check(batch).persist()
        try:
            scored = training.score_rows(model, row_rules.accepted(checked))
            scores = score_projection(scored, spec, threshold, with_actual=with_actual)
            scores.write.mode("overwrite").parquet(f"{path}/scores/batch={number}")
            refused = row_rules.rejected(checked)
            refused.write.mode("overwrite").parquet(f"{path}/rejects/batch={number}")
            is_refused = F.size("reasons") > 0
            counts = checked.agg(
                F.count_if(~is_refused).alias("n_scored"), F.count_if(is_refused).alias("n_refused")
            )
            counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/{COMMITS}/batch={number}")
        finally:
            checked.unpersist()

    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def committed(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``scores``, ``rejects`` or ``commits`` of the batches that were written whole."""
    commits = spark.read.parquet(f"{path}/{COMMITS}")
    if kind == COMMITS:
        return commits
    table = spark.read.parquet(f"{path}/{kind}")
    return table.join(F.broadcast(commits.select("batch")), "batch", "left_semi")
