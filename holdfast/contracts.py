"""The customer snapshot contract: column types, allowed values and roles (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from holdfast.spec import LabelSpec, ModelingSpec


@dataclass(frozen=True)
class ColumnRule:
    """What a raw column may hold."""

    name: str
    type: T.DataType
    nullable: bool = False
    domain: tuple = ()
    minimum: float | None = None


# Allowed values per column family.
YES_NO = ("Yes", "No")
GENDER = ("Male", "Female")
LINES = ("Yes", "No", "No phone service")
INTERNET = ("DSL", "Fiber optic", "No")
ADD_ON = ("Yes", "No", "No internet service")
CONTRACT = ("Month-to-month", "One year", "Two year")
PAYMENT = (
    "Electronic check",
    "Mailed check",
    "Bank transfer (automatic)",
    "Credit card (automatic)",
)


def _text(name: str, domain: tuple = ()) -> ColumnRule:
    return ColumnRule(name, T.StringType(), domain=domain)


# The raw snapshot layout, in file order.
SNAPSHOT_RULES: tuple[ColumnRule, ...] = (
    _text("customerID"),
    _text("gender", GENDER),
    ColumnRule("SeniorCitizen", T.LongType(), domain=(0, 1)),
    _text("Partner", YES_NO),
    _text("Dependents", YES_NO),
    ColumnRule("tenure", T.LongType(), minimum=0),
    _text("PhoneService", YES_NO),
    _text("MultipleLines", LINES),
    _text("InternetService", INTERNET),
    _text("OnlineSecurity", ADD_ON),
    _text("OnlineBackup", ADD_ON),
    _text("DeviceProtection", ADD_ON),
    _text("TechSupport", ADD_ON),
    _text("StreamingTV", ADD_ON),
    _text("StreamingMovies", ADD_ON),
    _text("Contract", CONTRACT),
    _text("PaperlessBilling", YES_NO),
    _text("PaymentMethod", PAYMENT),
    ColumnRule("MonthlyCharges", T.DoubleType(), minimum=0),
    ColumnRule("TotalCharges", T.DoubleType(), nullable=True, minimum=0),
    _text("Churn", YES_NO),
)

SNAPSHOT_SCHEMA = T.StructType(
    [T.StructField(r.name, r.type, nullable=True) for r in SNAPSHOT_RULES]
)

SNAPSHOT_SPEC = ModelingSpec(
    id_column="customerID",
    numeric={
        "SeniorCitizen": "flag",
        "tenure": "whole",
        "MonthlyCharges": "amount",
        "TotalCharges": "optional",
    },
    categorical=tuple(
        r.name
        for r in SNAPSHOT_RULES
        if isinstance(r.type, T.StringType) and r.name not in ("customerID", "Churn")
    ),
    label=LabelSpec("Churn"),
)
