"""All plans against the plain SQL on untidy tables."""

from __future__ import annotations

import duckdb
import pytest

from ledgerloom import catalogue, schemas
from ledgerloom.operators import lookups
from ledgerloom.sources import testdata
from ledgerloom.sources.tables import DocumentTables
from oracle.sql import sql
from tests import messy
from tests.compare import difference, spark_rows, sql_rows

SCANS = {"document_lines", "document_heads", "lookup_csv"}


@pytest.fixture(scope="module", params=[(1, 0), (2, 100 * 2**20), (3, 2**40)], ids=["small", "medium", "large"])
def both(request, spark, tmp_path_factory):
    """The same tables for Spark, stored as parquet, and for SQL.

    The lookups pass for small, medium and large, so each way to join them runs.
    """
    seed, size = request.param
    rows = messy.tables(seed)
    connection = duckdb.connect()
    messy.register(connection, rows)
    folder = tmp_path_factory.mktemp("messy")
    paths = {}
    for name in schemas.ALL:
        paths[name] = str(folder / name)
        connection.sql(f"SELECT * FROM {name}").write_parquet(paths[name])
    patch = pytest.MonkeyPatch()
    patch.setattr(lookups, "planned_bytes", lambda df: size)
    yield DocumentTables.load(spark, paths), connection
    patch.undo()


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - SCANS))
def test_query(both, monkeypatch, spark, name):
    tables, connection = both
    monkeypatch.setattr(testdata, "load", lambda spark, sf_dir: tables)
    names, rows = spark_rows(catalogue.QUERIES[name](spark, "unused"))
    sql_names, expected = sql_rows(connection, sql(name, given=tuple(schemas.ALL)))
    assert names == sql_names
    assert sum(expected.values()) > 0 or name == "full_row_duplicates"
    assert rows == expected, difference(rows, expected)
