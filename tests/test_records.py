from __future__ import annotations

import json

import pytest

from conftest import SAMPLE
from holdfast import SNAPSHOT_SPEC
from holdfast.contracts import SNAPSHOT_RULES
from holdfast.operators import row_rules
from holdfast.sources import records

NAMES = [r.name for r in SNAPSHOT_RULES]
GOOD = dict(zip(NAMES, SAMPLE[1], strict=True))
TYPED = GOOD | {"SeniorCitizen": 0, "tenure": 34, "MonthlyCharges": 56.95, "TotalCharges": 1889.5}


def without(name):
    return {k: v for k, v in TYPED.items() if k != name}


CASES = {
    "typed": (json.dumps(TYPED), []),
    "numbers as text": (json.dumps(GOOD), []),
    "no label, null and blank amount": (json.dumps(without("Churn") | {"TotalCharges": None}), []),
    "absent optional amount": (json.dumps(without("TotalCharges")), []),
    "fraction cut off": (json.dumps(TYPED | {"tenure": 34.9}), []),
    "fraction in text": (json.dumps(TYPED | {"tenure": "34.9"}), ["tenure: must be a whole number, 0 or more"]),
    "id a number": (json.dumps(TYPED | {"customerID": 12}), []),
    "cut short": (json.dumps(TYPED)[:-5], [records.MALFORMED]),
    "no JSON": ("customer 12", [records.MALFORMED]),
    "a list": (json.dumps([TYPED]), [records.MALFORMED]),
    "a number": ("5", [records.MALFORMED]),
    "empty": ("", [records.MALFORMED]),
    "null": (None, [records.MALFORMED]),
    "field twice": (json.dumps(TYPED)[:-1] + ', "tenure": 3}', [records.MALFORMED]),
    "number for text": (json.dumps(TYPED | {"Contract": 5}), ["Contract: must be text"]),
    "text for a number": (json.dumps(TYPED | {"MonthlyCharges": "much"}), ["MonthlyCharges: must be a number, 0 or more"]),
    "boolean for a number": (json.dumps(TYPED | {"tenure": True}), ["tenure: must be a number"]),
    "list for a number": (json.dumps(TYPED | {"TotalCharges": [1]}), ["TotalCharges: must be a number"]),
    "object for text": (json.dumps(TYPED | {"gender": {"a": 1}}), ["gender: must be text"]),
    "extra fields": (json.dumps(TYPED | {"zip": 1, "age": None}), ["age: unknown field", "zip: unknown field"]),
    "several": (
        json.dumps(without("gender") | {"zip": 1, "Contract": 2, "tenure": -1}),
        ["zip: unknown field", "Contract: must be text", "tenure: must be a whole number, 0 or more", "gender: must not be empty"],
    ),
}


@pytest.fixture(scope="module")
def checked(spark):
    rows = [(text, name) for name, (text, _) in CASES.items()]
    lines = spark.createDataFrame(rows, "value string, reasons string")
    return {r["_record"]: r for r in records.check_records(lines, SNAPSHOT_SPEC).collect()}


@pytest.mark.parametrize("name", CASES)
def test_reasons(checked, name):
    text, reasons = CASES[name]
    assert checked[text]["reasons"] == reasons


def test_accepted_records_equal_typed_rows(spark, sample, checked):
    row = checked[CASES["typed"][0]]
    typed = row_rules.check_rows(sample, SNAPSHOT_SPEC).where("customerID = '5575-GNVDE'").first()
    assert {k: row[k] for k in typed.asDict()} == typed.asDict()
    assert checked[CASES["fraction cut off"][0]]["tenure"] == 34
    assert checked[CASES["id a number"][0]]["customerID"] == "12"


def test_no_records(spark):
    assert records.check_records(spark.createDataFrame([], "value string"), SNAPSHOT_SPEC).collect() == []
