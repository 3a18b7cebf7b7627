"""Table and report writers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast.sources.readers import path_format


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet or CSV by suffix; anything else is an error."""
    if path_format(path) == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        # Text is written as it is: blanks at the ends kept, quotes doubled, line breaks quoted.
        writer = df.write.mode(mode).option("header", True).option("escape", '"')
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.csv(path)
    return path


def write_splits(split: DataFrame, path: str) -> str:
    """One table with a folder per split, so a reader of one split lists only its files."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def write_report(report: DataFrame, path: str) -> str:
    """A tidy report as JSON lines."""
    report.write.mode("overwrite").json(path)
    return path
