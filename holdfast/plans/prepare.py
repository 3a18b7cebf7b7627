"""Raw snapshot to splits: scan, repair, validate, split, write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from holdfast.contracts import SNAPSHOT_RULES, SNAPSHOT_SPEC, ColumnRule
from holdfast.functions import repair
from holdfast.operators import quality, splitting
from holdfast.sources import readers, sinks
from holdfast.spec import ModelingSpec, SplitSpec


def prepare_modeling(df: DataFrame, spec: ModelingSpec = SNAPSHOT_SPEC) -> DataFrame:
    """Nullable numbers read as doubles; flags as 0/1, missing ones as 0."""
    fixed = {}
    for c, kind in spec.numeric.items():
        if c not in df.columns:
            continue
        if kind == "optional":
            fixed[c] = repair.to_number(df, c)
        elif kind == "flag":
            fixed[c] = repair.to_flag(df, c)
    return df.withColumns(fixed) if fixed else df


def load_and_validate(
    spark: SparkSession,
    path: str,
    rules: Sequence[ColumnRule] = SNAPSHOT_RULES,
    spec: ModelingSpec = SNAPSHOT_SPEC,
    skip_validation: bool = False,
) -> DataFrame:
    """A raw CSV, repaired, checked and typed."""
    table = prepare_modeling(readers.read_raw_csv(spark, path, rules), spec)
    if not skip_validation:
        table = quality.assert_valid(table, rules)
    return readers.typed(table, rules)


def split_job(
    df: DataFrame, spec: ModelingSpec, split_spec: SplitSpec, output: str
) -> tuple[DataFrame, DataFrame]:
    """Write the split table and its manifest; returns both as read back.

    The sizes written are held against the quotas: repeated ids stop the job.
    """
    spark = df.sparkSession
    split = splitting.stratified_split(df, spec.id_column, spec.label.column, split_spec)
    path = sinks.write_splits(split, f"{output}/splits.parquet")
    written = spark.read.parquet(path)
    splitting.assert_quotas(written, spec.label.column, split_spec)
    manifest = splitting.split_manifest(written, spec.label)
    sinks.write_report(manifest, f"{output}/split_manifest.json")
    return written, manifest


def split_from_raw(
    spark: SparkSession,
    raw_csv: str,
    output: str,
    split_spec: SplitSpec = SplitSpec(),
    rules: Sequence[ColumnRule] = SNAPSHOT_RULES,
    spec: ModelingSpec = SNAPSHOT_SPEC,
    skip_validation: bool = False,
) -> tuple[DataFrame, DataFrame]:
    table = load_and_validate(spark, raw_csv, rules, spec, skip_validation)
    return split_job(table, spec, split_spec, output)
