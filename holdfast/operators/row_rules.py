"""Rules a scoring row must keep, as column expressions: accepted rows and rejects with reasons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import repair
from holdfast.operators.quality import ValidationError
from holdfast.spec import ModelingSpec


@dataclass(frozen=True)
class Reading:
    """How one field is read: the value kept and the test that it must pass."""

    name: str
    value: Column
    ok: Column
    reason: str


def _number_read(name: str) -> str:
    return f"_num_{name}"


def _first_look(df: DataFrame, spec: ModelingSpec, carry: Sequence[str]) -> DataFrame:
    """Text stripped, and every numeric field read once as ``_num_<field>`` with NaN kept.

    A projection of its own, so that the rules below do not read the text again and again.
    """
    texts = [c for c in df.columns if repair.is_text(df, c) and c not in carry]
    df = df.withColumns({c: repair.stripped(c) for c in texts})
    reads = {}
    for c in spec.numeric:
        if c in texts:
            not_a_number = F.lower(c).isin("nan", "+nan", "-nan")
            value = F.when(F.col(c).rlike(repair.READABLE_TEXT), F.col(c).try_cast("double"))
            reads[_number_read(c)] = F.when(not_a_number, F.lit(float("nan"))).otherwise(value)
        else:
            reads[_number_read(c)] = F.col(c).cast("double")
    return df.withColumns(reads)


def _cut_off(value: Column) -> Column:
    """Whole part of a finite number, towards zero; null for NaN and infinite ones."""
    finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
    return F.when(finite, F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)))


def _flag(df: DataFrame, name: str) -> Reading:
    cut = _cut_off(F.col(_number_read(name)))
    return Reading(name, cut.cast("int"), cut.isin(0, 1), "must be 0 or 1")


def _whole(df: DataFrame, name: str) -> Reading:
    """Integers zero or more; a fraction in a number column is cut off, in text it is refused."""
    cut = _cut_off(F.col(_number_read(name)))
    ok = cut >= 0
    if repair.is_text(df, name):
        ok = ok & F.col(name).rlike(repair.WHOLE_TEXT)
    return Reading(name, cut.cast("long"), ok, "must be a whole number, 0 or more")


def _amount(df: DataFrame, name: str) -> Reading:
    value = F.col(_number_read(name))
    return Reading(name, value, ~F.isnan(value) & (value >= 0), "must be a number, 0 or more")


def _optional(df: DataFrame, name: str) -> Reading:
    value = F.col(_number_read(name))
    blank = F.coalesce(F.col(name).cast("string"), F.lit("")) == ""
    return Reading(
        name, repair.nan_to_null(value), blank | value.isNotNull(), "must be a number or blank"
    )


def _number(df: DataFrame, name: str) -> Reading:
    value = F.col(_number_read(name))
    return Reading(name, repair.nan_to_null(value), value.isNotNull(), "must be a number")


_BY_KIND = {
    "flag": _flag,
    "whole": _whole,
    "amount": _amount,
    "optional": _optional,
    "number": _number,
}


def _text(df: DataFrame, name: str) -> Reading:
    """Text of one character or more, any value allowed; numbers are not taken for text."""
    if not repair.is_text(df, name):
        return Reading(name, F.col(name).cast("string"), F.lit(False), "must be text")
    return Reading(name, F.col(name), F.col(name) != "", "must not be empty")


def _id(df: DataFrame, name: str) -> Reading:
    return Reading(name, F.col(name), F.col(name).cast("string") != "", "must not be empty")


def unknown_columns(
    df: DataFrame, spec: ModelingSpec, carry: Sequence[str] = ()
) -> list[str]:
    """Columns a scoring table may not have, sorted."""
    known = {spec.id_column, *spec.features, spec.label.column, *carry}
    return sorted(set(df.columns) - known)


def missing_columns(df: DataFrame, spec: ModelingSpec) -> list[str]:
    """Required scoring columns that are absent, sorted; optional numbers and the label may be."""
    optional = {c for c, kind in spec.numeric.items() if kind == "optional"}
    return sorted({spec.id_column, *spec.features} - optional - set(df.columns))


def check_rows(df: DataFrame, spec: ModelingSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Read every row by the rules: repaired columns plus ``reasons`` (empty: accepted).

    An unknown or missing column refuses the whole table before any row is read. Columns in
    ``carry`` are let in and passed on as they are.
    """
    surplus, lacking = unknown_columns(df, spec, carry), missing_columns(df, spec)
    if surplus:
        raise ValidationError(f"unknown columns: {surplus}")
    if lacking:
        raise ValidationError(f"missing columns: {lacking}")
    for c, kind in spec.numeric.items():
        if kind == "optional" and c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    df = _first_look(df, spec, carry)

    readings = [
        _id(df, spec.id_column),
        *[_BY_KIND[kind](df, c) for c, kind in spec.numeric.items()],
        *[_text(df, c) for c in spec.categorical],
    ]
    reasons = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(r.ok, F.lit(False)), F.lit(f"{r.name}: {r.reason}"))
                for r in readings
            ]
        )
    )
    kept = list(carry)
    if spec.label.column in df.columns:
        kept.append(spec.label.column)
    return df.select(*[r.value.alias(r.name) for r in readings], *kept, reasons.alias("reasons"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def require_all(checked: DataFrame) -> DataFrame:
    """Fail-fast mode: the accepted table, or ValidationError when any row breaks a rule."""
    first = rejected(checked).select("reasons").limit(1).collect()
    if first:
        raise ValidationError(f"row refused: {list(first[0]['reasons'])}")
    return accepted(checked)
