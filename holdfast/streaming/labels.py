"""Labels that come after the scores: a stream of each, joined as they arrive, and the table form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.scoring import ACTUAL, PREDICTED
from holdfast.spec import ModelingSpec

SCORED, LABELLED = "scored_at", "labelled_at"
_COLUMNS = (SCORED, PREDICTED, LABELLED, ACTUAL)


def match_labels(scores: DataFrame, labels: DataFrame, spec: ModelingSpec, wait: str) -> DataFrame:
    """(id, scored_at, predicted, labelled_at, actual): each score with every label that its id gets
    within ``wait`` of it, or with nulls; the same for streams and tables.

    scores: id, scored_at, predicted. labels: id, labelled_at and the label column. Rows without id
    or time match nothing; labels without a value are none.
    """
    found = labels.where(F.col(spec.label.column).isNotNull()).select(
        F.col(spec.id_column).alias("_id"), LABELLED, F.col(spec.label.column).alias(ACTUAL)
    )
    scored = scores.select(spec.id_column, SCORED, PREDICTED)
    due = F.col(SCORED) + F.expr(f"interval {wait}")
    same = (F.col(spec.id_column) == F.col("_id")) & F.col(LABELLED).between(F.col(SCORED), due)
    return scored.join(found, same, "left_outer").select(spec.id_column, *_COLUMNS)


def first_labels(matched: DataFrame, spec: ModelingSpec) -> DataFrame:
    """One row per score: its earliest label (of equal times, the smaller), nulls if it got none.

    Repeated labels thus count once, in whatever order they came; repeated scores are one score.
    """
    first = F.min(F.struct(LABELLED, ACTUAL)).alias("first")
    found = matched.groupBy(spec.id_column, SCORED, PREDICTED).agg(first)
    return found.select(spec.id_column, SCORED, PREDICTED, f"first.{LABELLED}", f"first.{ACTUAL}")


def scored_with_labels(scores: DataFrame, labels: DataFrame, spec: ModelingSpec, wait: str) -> DataFrame:
    """The table form: every score with its first label within ``wait``."""
    return first_labels(match_labels(scores, labels, spec, wait), spec)


def label_stream(
    scores: DataFrame,
    labels: DataFrame,
    spec: ModelingSpec,
    wait: str,
    *,
    watermark: str,
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Join a stream of scores with a stream of labels as both arrive.

    A score with a label comes out when both are there; one without, as soon as the watermarks of both
    streams have passed its wait: until then it is open and has no row. State holds open scores and the
    labels that may still meet one, and is freed behind the watermark. Labels beyond the wait match
    nothing, like in a table. Rows that arrive more than ``watermark`` behind their stream are left
    out; ``scored_with_labels`` over the kept tables has those too. Each batch writes a folder of its
    own, replaced when the batch is replayed; ``streamed_labels`` reads them.
    """
    matched = match_labels(
        scores.withWatermark(SCORED, watermark), labels.withWatermark(LABELLED, watermark), spec, wait
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = matched.writeStream.outputMode("append").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def streamed_labels(spark: SparkSession, path: str, spec: ModelingSpec) -> DataFrame:
    """Every score that is no longer open, with its first label."""
    return first_labels(spark.read.parquet(path), spec)


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows per predicted and actual label, as ``scoring.scored_vs_actual`` counts them."""
    return labelled.groupBy(PREDICTED, ACTUAL).agg(F.count("*").alias("n_rows"))
