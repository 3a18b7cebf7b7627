"""Drift job: two files in, one report out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import drift
from holdfast.sources import readers, sinks
from holdfast.spec import ModelingSpec


def drift_from_paths(
    spark: SparkSession, reference: str, current: str, spec: ModelingSpec, alpha: float = 0.05
) -> DataFrame:
    return drift.drift_report(
        readers.read_table(spark, reference), readers.read_table(spark, current), spec, alpha
    )


def drift_job(
    spark: SparkSession,
    reference: str,
    current: str,
    spec: ModelingSpec,
    output: str,
    alpha: float = 0.05,
) -> DataFrame:
    """Write the report with both paths and alpha; returns it as read back."""
    report = drift_from_paths(spark, reference, current, spec, alpha).select(
        "*",
        F.lit(reference).alias("reference"),
        F.lit(current).alias("current"),
        F.lit(float(alpha)).alias("alpha"),
    )
    path = sinks.write_report(report, f"{output}/drift_report.json")
    schema = drift.REPORT_SCHEMA.simpleString()[len("struct<") : -1].replace(":", " ")
    return spark.read.schema(
        f"{schema}, reference string, current string, alpha double"
    ).json(path)
