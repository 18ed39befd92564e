"""Tables stored by document: no exchange for the document joins, same rows."""

from __future__ import annotations

import re

import pytest

from ledgerloom import schemas
from ledgerloom.operators.keys import KEY
from ledgerloom.plans import ar_mart, revenue_mart
from ledgerloom.sources import by_document as stored_by
from ledgerloom.sources.tables import DocumentTables
from tests import messy
from tests.test_operators import multiset
from tests.test_plans import NO_BROADCAST, conf, explain, scans  # noqa: F401

BUCKETS = 8


@pytest.fixture(scope="module")
def both(spark, make, tmp_path_factory):
    """The untidy tables as plain files and stored by document."""
    folder = tmp_path_factory.mktemp("by_document")
    rows = messy.tables(5)
    plain = {name: str(folder / name) for name in schemas.ALL}
    for name, path in plain.items():
        make(name, rows[name]).write.parquet(path)
    bucketed = dict(plain)
    for name in ("docline", "dochead"):
        path = str(folder / f"{name}_bucketed")
        stored_by.store_by_document(spark.read.parquet(plain[name]), path, BUCKETS)
        bucketed[name] = (path, "by_document")
    return DocumentTables.load(spark, plain), DocumentTables.load(spark, bucketed), bucketed


#: A hot document makes the untidy tables uneven; they are read by bucket here all the same.
@pytest.fixture(autouse=True)
def any_layout(monkeypatch):
    monkeypatch.setattr(stored_by, "UNEVEN", float(BUCKETS))


def test_documents_are_joined_without_an_exchange(both, conf):  # noqa: F811
    conf(NO_BROADCAST)
    plain, bucketed, _ = both
    config = ar_mart.ReceivablesConfig()
    assert "Exchange" in explain(ar_mart.documents(plain, config, True))
    plan = explain(ar_mart.documents(bucketed, config, True))
    assert "Exchange" not in plan and plan.count("SelectedBucketsCount: 8 out of 8") == 3
    # The whole mart: an exchange on both sides of the customer names, which are made distinct, and one to make rows distinct.
    whole = explain(ar_mart.ar_mart(bucketed))
    assert len(re.findall(r"\(\d+\) Exchange", whole)) == 4
    assert not any("key_" in args for args in re.findall(r"Exchange\nInput.*\nArguments: (.*)", whole))


def test_revenue_documents_are_joined_without_an_exchange(both, conf):  # noqa: F811
    conf(NO_BROADCAST)
    _, bucketed, _ = both
    for frame in (
        revenue_mart.with_line_fields(bucketed.docline, revenue_mart.head_rows(bucketed.dochead), revenue_mart.RevenueConfig()),
        revenue_mart.customer_lines(bucketed).select("ar_copies"),
    ):
        plan = explain(frame)
        assert not any("key_number" in args and "cmpcode" not in args for args in re.findall(r"Exchange\nInput.*\nArguments: (.*)", plan))


def test_company_filter_reaches_the_scan(both):
    _, bucketed, _ = both
    plan = explain(ar_mart.ar_mart(bucketed))
    pushed = [filters for filters, _ in scans(plan, "docline_bucketed")]
    assert len(pushed) == 2 and all("In(key_company" in filters for filters in pushed)


@pytest.mark.parametrize("name", ["ar_mart", "revenue", "revenue_once", "defaults"])
def test_same_rows(both, name):
    build = {
        "ar_mart": ar_mart.ar_mart,
        "revenue": revenue_mart.revenue_mart,
        "revenue_once": lambda t: revenue_mart.revenue_mart(t, dedup_ar_lines=True, drop_cdc_deletes=False, default_nulls="first"),
        "defaults": lambda t: revenue_mart.job_defaults(t, reduced=True),
    }[name]
    plain, bucketed, _ = both
    want = multiset(build(plain))
    assert multiset(build(bucketed)) == want and want


def test_another_session_reads_the_buckets(spark, both, conf):  # noqa: F811
    conf(NO_BROADCAST)
    _, _, paths = both
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for path, _ in (paths["docline"], paths["dochead"]):
        other.sql(f"DROP TABLE IF EXISTS {stored_by._name(path, BUCKETS)}")
    lines, heads = (stored_by.open_by_document(other, paths[n][0]) for n in ("docline", "dochead"))
    joined = lines.select(*KEY, "el2").join(heads.select(*KEY, "docdate"), list(KEY))
    assert "Exchange" not in explain(joined) and joined.count() > 0


def test_uneven_buckets_are_read_with_exchanges(spark, tmp_path, monkeypatch, conf):  # noqa: F811
    conf(NO_BROADCAST)
    monkeypatch.setattr(stored_by, "UNEVEN", 4.0)
    path = str(tmp_path / "t")
    rows = spark.range(3000).selectExpr(
        "'A' AS cmpcode", "' S ' AS doccode", "if(id < 2900, ' 1', string(id)) AS docnum", "id AS v"
    )
    layout = stored_by.store_by_document(rows, path, BUCKETS)
    assert layout.rows == 3000 and layout.most >= 2900 and not layout.even
    opened = stored_by.open_by_document(spark, path)
    assert set(opened.columns) == {"cmpcode", "doccode", "docnum", "v", *KEY} and opened.count() == 3000
    assert "Exchange" in explain(opened.join(opened.select(*KEY).distinct(), list(KEY)))


def test_replaced_partitioned_and_forgotten(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(500).selectExpr("concat('C', id % 3) AS cmpcode", "'S' AS doccode", "string(id) AS docnum", "id AS v")
    stored_by.store_by_document(rows.limit(7), path, 2)
    layout = stored_by.store_by_document(rows, path, 4, partition_by=("cmpcode",))
    assert stored_by.layout_of(spark, path)[:2] == (layout, ("cmpcode",))
    spark.sql(f"DROP TABLE {stored_by._name(path, 4)}")
    opened = stored_by.open_by_document(spark, path)
    assert opened.filter("cmpcode = 'C1'").count() == 167 and opened.count() == 500
    other = str(tmp_path / "u")
    stored_by.store_by_document(rows, other, 2)
    with pytest.raises(stored_by.UnlikeLayouts):
        stored_by.require_alike(spark, path, other)
    stored_by.forget(spark, path)
    assert not spark.catalog.tableExists(stored_by._name(path, 4))


def test_empty(spark, make, tmp_path):
    path = str(tmp_path / "t")
    stored_by.store_by_document(make("dochead", []), path, 4)
    assert stored_by.open_by_document(spark, path).count() == 0
