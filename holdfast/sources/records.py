"""Records that come as JSON text: fields by their JSON type, and what is wrong with a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators import row_rules
from holdfast.spec import ModelingSpec

#: The record as it came, and what is wrong with it as JSON.
RECORD, FAULTS = "_record", "_faults"
MALFORMED = "not a JSON object"
#: Longer records are not parsed.
MOST_BYTES = 16 << 20


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _number_as_text(value: Column, kind: str) -> Column:
    """A JSON number as text, as the rules would read it from a column of numbers."""
    if kind == "whole":  # there, a fraction is cut off
        value = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    return value.cast("string")


def parse_records(lines: DataFrame, spec: ModelingSpec, text: str = "value") -> DataFrame:
    """One row per line: the fields of the spec as text, ``_record`` and ``_faults``.

    A line that is not one JSON object (broken, another kind of value, a field named twice, null,
    over MOST_BYTES) has that one fault and no fields. Otherwise each unknown field is a fault, and
    each field of a wrong JSON type: numbers may come as numbers or as text, ids too; texts must be
    text. Absent fields and JSON nulls are null; the rules see to those. Other columns are left out.
    """
    raw = F.col(text)
    known = [spec.id_column, *spec.features, spec.label.column]
    parsed = lines.select(
        raw.alias(RECORD),
        F.when(F.octet_length(raw) <= MOST_BYTES, F.try_parse_json(raw)).alias("_json"),
        F.json_object_keys(raw).alias("_keys"),
    )
    whole = F.coalesce(F.startswith(F.schema_of_variant("_json"), F.lit("OBJECT")), F.lit(False))
    whole = whole & F.col("_keys").isNotNull()
    parsed = parsed.withColumn("_whole", whole)
    kinds, fields, faults = {}, [], []
    for i, c in enumerate(known):
        one = F.try_variant_get("_json", _path(c), "variant")
        kinds[f"_kind{i}"] = F.when(F.col("_whole"), F.schema_of_variant(one))
    typed = parsed.withColumns(kinds)
    for i, c in enumerate(known):
        kind = F.col(f"_kind{i}")
        is_text = kind == "STRING"
        is_number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        as_text = F.try_variant_get("_json", _path(c), "string")
        if c in spec.numeric:
            number = F.try_variant_get("_json", _path(c), "double")
            value = F.when(is_number, _number_as_text(number, spec.numeric[c])).when(is_text, as_text)
            fits, reason = is_text | is_number, "must be a number"
        elif c == spec.id_column:
            value, fits, reason = F.when(is_text | is_number, as_text), is_text | is_number, "must be text or a number"
        else:
            value, fits, reason = F.when(is_text, as_text), is_text, "must be text"
        fields.append(value.alias(c))
        there = kind.isNotNull() & (kind != "VOID")
        faults.append(F.when(there & ~fits, F.lit(f"{c}: {reason}")))
    unknown = F.array_sort(F.array_distinct(F.array_except("_keys", F.array(*[F.lit(c) for c in known]))))
    surplus = F.transform(unknown, lambda k: F.concat(k, F.lit(": unknown field")))
    wrong = F.concat(F.coalesce(surplus, F.array().cast("array<string>")), F.array_compact(F.array(*faults)))
    all_faults = F.when(F.col("_whole"), wrong).otherwise(F.array(F.lit(MALFORMED)))
    return typed.select(*fields, RECORD, all_faults.alias(FAULTS))


def check_records(lines: DataFrame, spec: ModelingSpec, text: str = "value") -> DataFrame:
    """Rows as ``row_rules.check_rows`` gives them, with ``_record``: the faults of a record come first
    among its reasons, and a field with a fault gives no second reason."""
    checked = row_rules.check_rows(parse_records(lines, spec, text), spec, carry=[RECORD, FAULTS])
    field = lambda r: F.substring_index(r, ": ", 1)
    named = F.transform(FAULTS, field)
    rest = F.filter("reasons", lambda r: ~F.array_contains(named, field(r)))
    broken = F.array_contains(FAULTS, MALFORMED)
    reasons = F.when(broken, F.col(FAULTS)).otherwise(F.concat(FAULTS, rest))
    return checked.withColumn("reasons", reasons).drop(FAULTS)
