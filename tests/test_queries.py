"""Every registered query beside its SQL at the smallest scale; the contract of the entry file."""

import pytest

import __spark_entry__ as entry_file
from conftest import SMALL
from oracle_check import compare, connect

QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    assert compare(spark, con, key, SMALL) == ""


def test_entry(spark):
    rows = entry_file.entry(spark).collect()
    assert {r["split"] for r in rows} == {"validation", "test"}
