"""Results of a search as a table that outlives its driver: one small append for each fit."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources import fingerprint
from holdfast.sources.readers import path_exists
from holdfast.spec import ModelingSpec, SearchSpec

RESULT_SCHEMA = "roc_auc double, params map<string,string>, point string, fold int"
TRIAL_SCHEMA = "trial int, fold int, roc_auc double, params map<string,string>"


def _digest(facts: Any) -> str:
    return hashlib.sha256(json.dumps(facts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def point_key(point: Mapping[str, Any]) -> str:
    """A name for the settings of one fit, whatever their order."""
    return _digest(dict(point))


def search_key(train: DataFrame, spec: ModelingSpec, search: SearchSpec) -> str:
    """A name for what a fit depends on beside its settings: rows, columns, folds, seed, weighting.

    The rows count by content, in any order and layout: one pass over them.
    """
    columns = [spec.id_column, *spec.features, spec.label.column]
    rows = fingerprint.content_fingerprint(train, columns).first()
    label = (spec.label.column, spec.label.positive, spec.label.negative)
    settings = (search.folds, search.seed, search.unbalance)
    return _digest([list(rows), columns, dict(spec.numeric), label, settings])


class SearchLedger:
    """The results of one search under a path that may hold those of many.

    Each fit has a folder of its own, named by its settings and fold. Writing it again replaces it, so
    a fit that is repeated after a lost driver counts once; a folder whose write was broken off holds
    no rows and counts as missing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path = spark, f"{path.rstrip('/')}/search={key}"

    def append(self, point: Mapping[str, Any], fold: int, roc_auc: float) -> None:
        row = [(float(roc_auc), {k: str(v) for k, v in point.items()})]
        table = self.spark.createDataFrame(row, "roc_auc double, params map<string,string>").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.path}/point={point_key(point)}/fold={fold}")

    def results(self) -> DataFrame:
        """(roc_auc, params, point, fold) of every finished fit."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        return self.spark.read.schema(RESULT_SCHEMA).option("basePath", self.path).parquet(self.path)

    def finished(self) -> set[tuple[str, int]]:
        """(point, fold) of every finished fit: as many as the search has."""
        return {(r["point"], r["fold"]) for r in self.results().select("point", "fold").collect()}

    def trials(self, points: Sequence[Mapping[str, Any]]) -> DataFrame:
        """(trial, fold, roc_auc, params) of the given points, a trial being a point's place.

        Results of other points, from a search with other draws over the same rows, stay out.
        """
        places = [(point_key(p), i) for i, p in enumerate(points)]
        named = self.spark.createDataFrame(places, "point string, trial int")
        found = self.results().join(F.broadcast(named), "point")
        return found.select("trial", "fold", "roc_auc", "params")
