"""Every registered query with a SQL counterpart gives exactly its rows (smallest scale)."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck("0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    problem = compare(spark, con, QUERIES[name], ORACLES[name], "0.001")
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
