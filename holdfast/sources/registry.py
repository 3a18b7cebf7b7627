"""Append-only tables around the models: runs, frozen champions, scoring runs."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources.readers import path_exists

RUN_SCHEMA = (
    "run_id string, parent_run_id string, name string, params map<string,string>, "
    "metrics map<string,double>, tags map<string,string>"
)
CHAMPION_SCHEMA = (
    "model_path string, model_source string, threshold double, threshold_selected_on string, "
    "recall_floor double, beta double, floor_kept boolean, test_metrics map<string,double>"
)


def _append(spark: SparkSession, rows: Sequence[tuple], schema: str, path: str) -> None:
    stamped = spark.createDataFrame(list(rows), schema).withColumn("ts", F.current_timestamp())
    stamped.coalesce(1).write.mode("append").parquet(path)


def new_run_id() -> str:
    return uuid.uuid4().hex


def run_row(
    name: str,
    params: Mapping[str, Any],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
    parent: str | None = None,
    run_id: str | None = None,
) -> tuple:
    return (
        run_id or new_run_id(), parent, name,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        dict(tags or {}),
    )


def log_runs(spark: SparkSession, path: str, rows: Sequence[tuple]) -> None:
    """Append runs (a parent and its trials go in one write)."""
    _append(spark, rows, RUN_SCHEMA, path)


def leaderboard(runs: DataFrame, metric: str) -> DataFrame:
    """Top-level runs that report the metric, best first, with all their metrics in long form."""
    top = runs.where(F.col("parent_run_id").isNull() & F.col("metrics")[metric].isNotNull())
    long = top.select(
        "run_id", "name", F.col("metrics")[metric].alias("_best"),
        F.explode("metrics").alias("metric", "value"),
    )
    wide = long.groupBy("run_id", "name", "_best").pivot("metric").agg(F.first("value"))
    return wide.orderBy(F.desc("_best"), "name").drop("_best")


def freeze_champion(
    spark: SparkSession,
    path: str,
    *,
    model_path: str,
    model_source: str,
    threshold: float,
    recall_floor: float,
    beta: float,
    floor_kept: bool,
    test_metrics: Mapping[str, float],
) -> None:
    row = (
        model_path, model_source, float(threshold), "validation", float(recall_floor),
        float(beta), bool(floor_kept), {k: float(v) for k, v in test_metrics.items()},
    )
    _append(spark, [row], CHAMPION_SCHEMA, path)


def read_champion(spark: SparkSession, path: str) -> dict[str, Any]:
    """Latest frozen champion; it must name a model and a threshold."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as err:
        raise FileNotFoundError(f"no champion table at {path}") from err
    lacking = [c for c in ("model_path", "threshold") if c not in table.columns]
    if lacking:
        raise ValueError(f"champion lacks {lacking}")
    order = [F.desc("ts")] if "ts" in table.columns else []
    latest = table.orderBy(*order).limit(1).collect() if order else table.limit(1).collect()
    if not latest:
        raise ValueError("champion table is empty")
    row = latest[0].asDict(recursive=True)
    for field in ("model_path", "threshold"):
        if row[field] is None:
            raise ValueError(f"champion lacks {field}")
    return row


def resolve_model(
    spark: SparkSession,
    override: str | None = None,
    champion: str | None = None,
    fallback: str | None = None,
) -> tuple[str, str]:
    """(path, which): a given path as it is, else the champion's, else the fallback."""
    if override is not None:
        return override, "override"
    for which, path in (("champion", champion), ("fallback", fallback)):
        if path is not None and path_exists(spark, f"{path}/metadata"):
            return path, which
    raise FileNotFoundError(f"no model at {champion!r} or {fallback!r}")
