"""Binding of tables, sinks and read-back."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pytest

from ledgerloom import schemas
from ledgerloom.sources import sinks, tables, testdata
from ledgerloom.sources.tables import DocumentTables, SchemaMismatch, conform, read_csv, read_table
from tests import messy
from tests.conftest import SF_DIR


def test_conform_prunes_orders_and_casts(spark):
    df = spark.createDataFrame(
        [("EUR", 5, "n", "c", "k", datetime(2024, 7, 23, 13, 0), "I", "extra")],
        "curdoc string, more int, docnum string, doccode string, cmpcode string, "
        "docdate timestamp, cdc_operation_type string, other string",
    )
    bound = conform(df, schemas.DOCHEAD, "dochead")
    assert bound.schema == schemas.DOCHEAD
    assert bound.first().docdate == date(2024, 7, 23)


def test_missing_column(spark):
    with pytest.raises(SchemaMismatch, match="homecur"):
        conform(spark.createDataFrame([("a",)], "code string"), schemas.COMPANY, "company")


def test_tables_bind_on_demand(spark, tmp_path):
    spark.createDataFrame([("a", "USD")], "code string, homecur string").write.parquet(str(tmp_path / "c"))
    t = DocumentTables.load(spark, {"company": str(tmp_path / "c"), "dochead": str(tmp_path / "absent")})
    assert t.company.collect() == [("a", "USD")]
    assert t.company is t.company
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        t.dochead
    with pytest.raises(SchemaMismatch):
        t.docline
    with pytest.raises(AttributeError):
        t.unheard_of
    with pytest.raises(ValueError):
        DocumentTables(unheard_of=t.company)


def test_read_table_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "USD", 1)], "code string, homecur string, n int").write.orc(path)
    assert read_table(spark, path, fmt="orc").columns == ["code", "homecur", "n"]
    assert read_table(spark, path, schemas.COMPANY, "orc").columns == ["code", "homecur"]


def test_csv_lookup(spark, tmp_path):
    path = tmp_path / "category.csv"
    path.write_text(
        "Facility|GLCode-CPQREF,AI Enhanced - CPQ Category,AI Enhanced - CPQ SubCategory\n"
        'BASD1,"a, b",c\nBASD2,,c\n'
    )
    assert read_csv(spark, str(path), schemas.CATEGORY).collect() == [("BASD1", "a, b", "c"), ("BASD2", None, "c")]
    t = DocumentTables.load(spark, {"category": str(path)})
    assert t.category.count() == 2


def test_csv_with_other_header(spark, tmp_path):
    path = tmp_path / "company.csv"
    path.write_text("homecur,code\nUSD,a\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(path), schemas.COMPANY).collect()


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, gone int")
    new = spark.createDataFrame([("c", 2.5)], "k string, `AR Billing Site` double")
    sinks.overwrite(old, path)
    sinks.overwrite(new, path)
    back = sinks.read_back(spark, path)
    assert back.schema == new.schema
    assert back.collect() == new.collect()
    assert sinks.written_rows(spark, path) == 1


def test_overwrite_keeps_old_columns_when_asked(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.overwrite(spark.createDataFrame([("a", 1)], "k string, gone int"), path, evolve_schema=True)
    sinks.overwrite(spark.createDataFrame([("c", 2.5)], "k string, n double"), path, evolve_schema=True)
    assert sinks.read_back(spark, path).select("k", "n", "gone").collect() == [("c", 2.5, None)]


def test_partitioned_sink(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("BAS", 1), ("HEG", 2)], "cmpcode string, n int")
    sinks.overwrite(df, path, partition_by=("cmpcode",), rebalance=True)
    assert sinks.read_back(spark, path).filter("cmpcode = 'HEG'").select("n").collect() == [(2,)]


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`AR Billing Site` int, `a,b;c{d}e(f)g=h` int, ok int")
    assert sinks.sanitize_columns(df).columns == ["AR_Billing_Site", "a_b_c_d_e_f_g_h", "ok"]
    with pytest.raises(ValueError, match="a_b"):
        sinks.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


UNTIDY = [("a", 'say "hi", ok', "two\nlines"), ("b", "", None), ("c", " padded ", "x,y"), ("d", '""', "\\ back"), ("e", "é\r\nz", "")]


@pytest.mark.parametrize("null_text", ["", "\\N"])
def test_csv_round_trip(spark, tmp_path, null_text):
    df = spark.createDataFrame(UNTIDY, schemas.CATEGORY)
    tables.write_csv(df, f"{tmp_path}/c", null_text)
    got = {tuple(row) for row in tables.read_csv(spark, f"{tmp_path}/c", schemas.CATEGORY, null_text).collect()}
    want = {tuple(v if v != "" or null_text else None for v in row) for row in UNTIDY}
    assert got == want


def test_csv_as_spreadsheets_write_it(spark, tmp_path):
    header = ",".join(f'"{name}"' for name in schemas.CATEGORY.names)
    (tmp_path / "one.csv").write_text(header + '\r\nA,"say ""hi"", ok",s\r\nB,"first\nsecond",\r\n')
    (tmp_path / "two.csv").write_text(header + "\nC,,last\n")
    loaded = DocumentTables.load(spark, {"category": (str(tmp_path), "csv")})
    assert {tuple(row) for row in loaded.category.collect()} == {
        ("A", 'say "hi", ok', "s"), ("B", "first\nsecond", None), ("C", None, "last"),
    }


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(",".join(schemas.CATEGORY.names) + "\nA,b,c,d\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, str(tmp_path), schemas.CATEGORY).select(schemas.CATEGORY.names[0]).collect()


def test_schema_evolution_rejects_a_changed_type(spark, tmp_path):
    sinks.overwrite(spark.range(3).selectExpr("id AS a"), f"{tmp_path}/t")
    with pytest.raises(sinks.ChangedType, match="a"):
        sinks.overwrite(spark.range(3).selectExpr("string(id) AS a"), f"{tmp_path}/t", evolve_schema=True)


def test_scratch_is_removed(spark):
    from pathlib import Path

    from __spark_entry__ import QUERIES

    root = Path(sinks.scratch_path(spark, "x").removeprefix("file:")).parent
    assert QUERIES["lookup_csv"](spark, SF_DIR).count() > 0
    assert not list(root.glob("category-*"))


def test_scratch_folder_without_a_scheme(spark, tmp_path, monkeypatch):
    """On a cluster it is a folder of the default file system, not an error."""
    from __spark_entry__ import QUERIES

    get, folder = type(spark.conf).get, str(tmp_path / "shared")
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *rest: folder if key == "spark.checkpoint.dir" else get(self, key, *rest))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    assert sinks.scratch_path(spark, "x").startswith(f"file:{folder}/x-")
    assert QUERIES["lookup_csv"](spark, SF_DIR).count() > 0
    assert not list((tmp_path / "shared").glob("category-*"))
    folder = "shared"
    assert sinks.scratch_path(spark, "x").startswith("file:/")


@pytest.mark.parametrize("name", [
    "ar_mart_listed",
    "full_row_duplicates",
    "lookup_csv",
    "revenue_mart_by_document",
    "sink_checked",
    "sink_roundtrip",
])
def test_stored_queries_off_a_local_master(spark, make_tables, tmp_path, monkeypatch, name):
    """The rows are those of a local run, and nothing stays in a folder without a scheme."""
    from ledgerloom import catalogue

    untidy = make_tables(**messy.tables(1))
    monkeypatch.setattr(testdata, "load", lambda *_: untidy)
    local = Counter(map(str, catalogue.QUERIES[name](spark, "").collect()))
    get, folder = type(spark.conf).get, tmp_path / "shared"
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *rest: str(folder) if key == "spark.checkpoint.dir" else get(self, key, *rest))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    assert Counter(map(str, catalogue.QUERIES[name](spark, "").collect())) == local
    assert folder.exists() and not list(folder.iterdir())
