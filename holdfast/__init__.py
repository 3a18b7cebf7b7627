"""Customer-churn analytics on Spark: DataFrame in, DataFrame out."""

from holdfast.contracts import SNAPSHOT_RULES, SNAPSHOT_SCHEMA, SNAPSHOT_SPEC, ColumnRule
from holdfast.spec import (
    EvalSpec,
    LabelSpec,
    LogisticSpec,
    ModelingSpec,
    SearchSpec,
    SplitSpec,
)

__all__ = [
    "ColumnRule",
    "EvalSpec",
    "LabelSpec",
    "LogisticSpec",
    "ModelingSpec",
    "SNAPSHOT_RULES",
    "SNAPSHOT_SCHEMA",
    "SNAPSHOT_SPEC",
    "SearchSpec",
    "SplitSpec",
]
