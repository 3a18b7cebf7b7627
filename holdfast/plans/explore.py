"""Exploratory summary as a job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast.operators import eda
from holdfast.sources import sinks
from holdfast.spec import LabelSpec


def eda_job(df: DataFrame, label: LabelSpec, output: str) -> DataFrame:
    """Write the tidy summary as JSON and hand it back as read."""
    path = sinks.write_report(eda.eda_summary(df, label), f"{output}/eda_summary.json")
    return df.sparkSession.read.schema("section string, name string, value double").json(path)
