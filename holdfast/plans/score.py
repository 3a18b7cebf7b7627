"""Batch scoring: scan, row rules, model, cut, projection, sink, record of the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.functions import repair
from holdfast.operators import row_rules, scoring, training
from holdfast.sources import fingerprint, readers, registry, sinks
from holdfast.spec import ModelingSpec

FAILFAST, QUARANTINE = "failfast", "quarantine"
#: Helper column with the digest of the row as it was read.
DIGEST = "_row_digest"
SCORING_RUN_SCHEMA = (
    "version string, champion_path string, model_path string, threshold double, "
    "threshold_source string, input_path string, input_digest string, n_rows long, "
    "n_rejected long, output_path string"
)


@dataclass(frozen=True)
class Scored:
    scores: DataFrame
    rejects: DataFrame | None
    metadata: dict


def score_table(
    df: DataFrame,
    model: PipelineModel,
    spec: ModelingSpec,
    threshold: float,
    mode: str = FAILFAST,
    with_actual: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(scores, rejects) of a table. ``failfast`` raises on the first refused row."""
    if mode not in (FAILFAST, QUARANTINE):
        raise ValueError(f"unknown mode {mode!r}")
    checked = row_rules.check_rows(df, spec)
    rows = row_rules.require_all(checked) if mode == FAILFAST else row_rules.accepted(checked)
    if with_actual is None:
        with_actual = scoring.has_labels(rows, spec)
    scored = training.score_rows(model, rows)
    projected = scoring.score_projection(scored, spec, threshold, with_actual=with_actual)
    return projected, row_rules.rejected(checked)


def score_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    spec: ModelingSpec,
    champion_path: str,
    *,
    threshold_override: float | None = None,
    mode: str = FAILFAST,
    rejects_path: str | None = None,
    runs_path: str | None = None,
    version: str = "v1",
) -> Scored:
    """Score a file with the frozen champion.

    ``failfast`` (the default) stops at the first refused row, before anything is written to the
    output. ``quarantine`` writes refused rows with their reasons to ``rejects_path``, which it
    demands: every row read is either scored or refused, and both are counted.

    The input is read once: its rows, as the rules read them, are written with their reasons and
    digests, and scores, rejects, counts and fingerprint all come from there.
    """
    if mode not in (FAILFAST, QUARANTINE):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == QUARANTINE and rejects_path is None:
        raise ValueError("quarantine needs a rejects_path: refused rows must not be lost")
    champion = registry.read_champion(spark, champion_path)
    overridden = threshold_override is not None
    threshold = float(threshold_override if overridden else champion["threshold"])
    table = readers.read_table(spark, input_path)
    if readers.path_format(input_path) == "csv":
        table = _numbers_from_text(table, spec)
    model = PipelineModel.load(champion["model_path"])
    checked = row_rules.check_rows(
        table.withColumn(DIGEST, fingerprint.row_digest(table)), spec, carry=[DIGEST]
    )
    staged = workspace.new_path(spark, "checked")
    checked.write.parquet(staged)
    checked = spark.read.schema(checked.schema).parquet(staged)
    refused = F.size("reasons") > 0
    facts = checked.agg(
        F.count_if(refused).alias("n_rejected"), *fingerprint.digest_sums(F.col(DIGEST))
    ).first()
    if mode == FAILFAST:
        row_rules.require_all(checked)
    rows = checked.drop(DIGEST)
    accepted = row_rules.accepted(rows)
    scored = training.score_rows(model, accepted)
    with_actual = scoring.has_labels(accepted, spec)
    scores = scoring.score_projection(scored, spec, threshold, with_actual=with_actual)

    sinks.write_table(scores, output_path)
    written = readers.read_table(spark, output_path)
    rejects = None
    if mode == QUARANTINE:
        sinks.write_table(row_rules.rejected(rows), rejects_path)
        rejects = spark.read.parquet(rejects_path)
    metadata = {
        "version": version,
        "champion_path": champion_path,
        "model_path": champion["model_path"],
        "threshold": threshold,
        "threshold_source": "override" if overridden else "champion",
        "input_path": input_path,
        "input_digest": facts["digest_sum"],
        "n_rows": facts["n_rows"] - facts["n_rejected"],
        "n_rejected": facts["n_rejected"],
        "output_path": output_path,
    }
    if runs_path is not None:
        spark.createDataFrame([tuple(metadata.values())], SCORING_RUN_SCHEMA).withColumn(
            "ts", F.current_timestamp()
        ).coalesce(1).write.mode("append").parquet(runs_path)
    return Scored(written, rejects, metadata)


def _numbers_from_text(table: DataFrame, spec: ModelingSpec) -> DataFrame:
    """CSV columns are text: a whole column of readable numbers is numeric, as a reader infers.

    Only ``whole`` fields differ between text and numbers (a fraction is refused in text and cut
    off in a number), so only they are looked at, in one pass.
    """
    whole = [c for c, k in spec.numeric.items() if k == "whole" and c in table.columns]
    if not whole:
        return table
    unreadable = table.agg(
        *[
            F.count_if(repair.blank_to_null(c).isNotNull() & repair.to_number(table, c).isNull())
            .alias(c)
            for c in whole
        ]
    ).first()
    numeric = {c: repair.to_number(table, c) for c in whole if unreadable[c] == 0}
    return table.withColumns(numeric) if numeric else table
