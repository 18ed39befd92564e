from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom import schemas  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources.tables import DocumentTables  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "ledgerloom-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """A frame of one of the declared tables from rows given as dicts; absent columns are NULL."""

    def build(name: str, rows: list[dict]):
        schema = schemas.ALL[name]
        values = [tuple(row.get(column) for column in schema.names) for row in rows]
        return spark.createDataFrame(values, schema)

    return build


@pytest.fixture(scope="session")
def make_tables(make):
    """Document tables from rows; tables that are not given are empty."""

    def build(**rows: list[dict]) -> DocumentTables:
        return DocumentTables(**{name: make(name, rows.get(name, [])) for name in schemas.ALL})

    return build
