"""Every registered query against its SQL, on whole test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference, spark_rows, sql_rows
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(contract.QUERIES) == set(contract.ORACLE)


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query(spark, duck, name):
    names, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    sql_names, expected = sql_rows(duck, contract.oracle_sql()[name])
    assert names == sql_names
    assert rows == expected, difference(rows, expected)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
