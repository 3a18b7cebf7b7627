"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.contracts import SNAPSHOT_RULES, ColumnRule
from holdfast.functions import repair
from holdfast.sources import csv_blocks

PARQUET_SUFFIXES = (".parquet", ".pq")
CSV_SUFFIXES = (".csv",)


def path_format(path: str) -> str:
    """parquet or csv, by suffix; anything else is an error."""
    lower = path.rstrip("/").lower()
    if lower.endswith(PARQUET_SUFFIXES):
        return "parquet"
    if lower.endswith(CSV_SUFFIXES):
        return "csv"
    raise ValueError(f"unsupported table format: {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything can be read at a path, on any file system Spark knows."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException:
        return False
    return True


def _csv_reader(spark: SparkSession) -> DataFrameReader:
    """Standard CSV: quotes inside quoted text are doubled. Files are read in blocks.

    A line break inside quotes is an error, as is any line with too few or too many fields.
    """
    return spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST")


def _header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    """Column names of the first file: its first record is read, and nothing inferred."""
    return _csv_reader(spark).option("multiLine", multi_line).csv(path).columns


def _csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    if multi_line:
        return csv_blocks.read_csv(spark, path, schema, _header(spark, path, True))
    return _csv_reader(spark).schema(schema).option("enforceSchema", False).csv(path)


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, every column as text, in any order.

    ``columns``: the header must hold exactly these. All files must share one header.
    ``multi_line``: quoted text may hold line breaks. Files are still read in blocks, by counting
    quotes first (``csv_blocks``).
    """
    header = _header(spark, path, multi_line)
    if columns is not None and sorted(header) != sorted(columns):
        odd = sorted(set(header) ^ set(columns))
        raise ValueError(f"CSV header and expected columns differ in {odd}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    text = _csv(spark, path, schema, multi_line)
    return text if columns is None else text.select(*columns)


def typed(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Text columns turned into the rule's type where every rule allows it; unreadable is null."""
    out = []
    for r in rules:
        if isinstance(r.type, T.DoubleType):
            out.append(repair.to_number(df, r.name).alias(r.name))
        elif isinstance(r.type, T.IntegralType):
            text = repair.stripped(r.name)
            out.append(F.when(text.rlike(repair.WHOLE_TEXT), text.try_cast(r.type)).alias(r.name))
        else:
            out.append(F.col(r.name))
    return df.select(*out)


def read_raw_csv(
    spark: SparkSession, path: str, rules: Sequence[ColumnRule] = SNAPSHOT_RULES
) -> DataFrame:
    """Raw snapshot CSV as text, with the nullable numbers repaired (blank becomes null).

    The other columns stay text, so that the type rules still see what the file held.
    """
    text = read_text_csv(spark, path)
    blankable = [
        r.name
        for r in rules
        if r.nullable and isinstance(r.type, T.DoubleType) and r.name in text.columns
    ]
    return text.withColumns({c: repair.to_number(text, c) for c in blankable})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with NaN turned into null."""
    return repair.clean_nans(spark.read.parquet(path))


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan by suffix. A CSV without a schema comes back as text columns."""
    if path_format(path) == "parquet":
        return read_parquet(spark, path)
    if schema is None:
        return read_text_csv(spark, path, multi_line=multi_line)
    return repair.clean_nans(_csv(spark, path, schema, multi_line))
