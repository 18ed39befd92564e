"""Joins of keys with many rows on both sides, and duplicates by fingerprint."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, grid
from ledgerloom.plans import revenue_mart
from ledgerloom.sources.tables import DocumentTables
from tests.test_operators import multiset
from tests.test_plans import conf, explain  # noqa: F401


@pytest.mark.parametrize("slots", [1, 1 << 16])
@pytest.mark.parametrize("block", [1, 3, 1000])
def test_grid_join_is_join(spark, monkeypatch, block, slots):
    monkeypatch.setattr(grid, "SLOTS", slots)
    left = spark.range(60).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE string(id % 5) END AS k", "id % 2 AS n", "id AS a")
    right = spark.range(50).selectExpr("CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE string(id % 9) END AS k", "id % 2 AS n", "id AS b")
    left, right = left.unionByName(left.limit(5)), right.unionByName(right.limit(5))
    joined = grid.grid_join(left, right, ["k", "n"], block)
    plain = left.join(right, ["k", "n"])
    assert joined.columns == plain.columns and multiset(joined) == multiset(plain)
    assert grid.grid_join(left.limit(0), right, ["k", "n"], block).count() == 0


def test_a_document_hot_on_both_sides_is_dealt(spark):
    """3,000 x 3,000 rows: no place holds more than about a block of either side."""
    left = spark.range(3000).selectExpr("'BAS' AS c", "'1' AS d", "id AS a")
    right = spark.range(3000).selectExpr("'BAS' AS c", "'1' AS d", "-id AS b")
    dims = grid.grids(left, right, ["c", "d"], 256)
    assert [(r.tall, r.wide) for r in dims.collect()] == [(12, 12)]
    for side, own, other in ((left, "tall", "wide"), (right, "wide", "tall")):
        places = grid.dealt(side, ["c", "d"], dims, own, other).groupBy("__tall", "__wide").count()
        sizes = [r["count"] for r in places.collect()]
        assert len(sizes) == 144 and max(sizes) < 1.5 * 256
    joined = grid.grid_join(left, right, ["c", "d"], 256)
    assert joined.count() == 9_000_000 and joined.select(F.sum(F.col("a") + F.col("b"))).first()[0] == 0


def test_revenue_of_a_document_with_many_lines_and_customers(spark, make):
    lines = spark.range(0, 1200, 1, 4).select(
        F.lit("BAS").alias("cmpcode"), F.lit("SINV").alias("doccode"), F.expr("if(id < 1000, '1', string(id))").alias("docnum"),
        F.lit(84).alias("statpay"), *[F.lit(200).cast("long").alias(c) for c in ("valuedoc", "valuehome")],
        *[F.lit(2).alias(c) for c in ("valuedoc_dp", "valuehome_dp")],
        F.expr("if(id % 2 = 0, '0211', '40100')").alias("el2"), F.expr("concat('D', id)").alias("el3"), F.lit("").alias("el4"),
        *[F.expr(f"concat('{c}', id)").alias(c) for c in ("ref1", "ref2", "ref3", "ref4", "ref5")],
    )
    from datetime import date

    heads = [{"cmpcode": "BAS", "doccode": "SINV", "docnum": " 1", "docdate": date(2020, 1, 1), "curdoc": "USD", "cdc_operation_type": "I"}]
    customers = [{"el3_cmpcode": "BAS", "el3_code": f"D{i}", "el3_elmlevel": 3, "el3_name": "n"} for i in range(1200)]
    t = DocumentTables(
        docline=lines, dochead=make("dochead", heads), company=make("company", [{"code": "BAS", "homecur": "USD"}]),
        el2_element=make("el2_element", [{"el2_cmpcode": "BAS", "el2_code": "40100", "el2_elmlevel": 2, "el2_name": "a"}]),
        el3_element=make("el3_element", customers),
    )
    plain, dealt = (revenue_mart.revenue_mart(t, deal_hot_documents=x) for x in (False, True))
    assert "grid_slot" in explain(dealt) and "grid_slot" not in explain(plain)
    totals = [f.agg(F.count("*"), F.sum("valuehome"), F.sum(F.hash("el3", "CustomerNumber"))).first() for f in (plain, dealt)]
    assert totals[0] == totals[1] and totals[0][0] == 500 * 500


def _crowded_tables(make_tables, names: int = 1):
    """Documents of (revenue lines, lines that name a customer, headers)."""
    from datetime import date

    key = {"cmpcode": "BAS", "doccode": "SINV"}
    amounts = {"valuedoc": 200, "valuehome": 200, "valuedoc_dp": 2, "valuehome_dp": 2, "statpay": 84, "el4": "", "ref2": "r"}
    lines, heads = [], []
    for number, (revenue, customers, copies) in {"1": (3, 2, 1), "2": (1, 1, 1), "3": (1, 1, 6), "4": (9, 0, 1), "5": (2, 2, 1)}.items():
        accounts = ["40100"] * revenue + ["0211"] * customers
        lines += [{**key, **amounts, "docnum": number, "el2": el2, "el3": f"D{i}"} for i, el2 in enumerate(accounts)]
        heads += [{**key, "docnum": f" {number}", "docdate": date(2020, 1, 1 + i), "curdoc": "USD", "cdc_operation_type": "I"} for i in range(copies)]
    elements = [{"el3_cmpcode": "BAS", "el3_code": f"D{i}", "el3_elmlevel": 3, "el3_name": f"n{n}"} for i in range(9) for n in range(names)]
    accounts = [{"el2_cmpcode": "BAS", "el2_code": "40100", "el2_elmlevel": 2, "el2_name": "a"}]
    return make_tables(docline=lines, dochead=heads, company=[{"code": "BAS", "homecur": "USD"}], el2_element=accounts, el3_element=elements)


@pytest.mark.parametrize(("names", "kept"), [(1, {"1", "3"}), (2, {"1", "3", "5"}), (5, {"1", "2", "3", "5"})])
def test_documents_that_may_make_many_pairs(make_tables, names, kept):
    t = _crowded_tables(make_tables, names)
    cut = revenue_mart.crowded(t, block=2)
    for table in ("docline", "dochead"):
        assert multiset(getattr(cut, table)) == multiset(getattr(t, table).filter(F.trim("docnum").isin(*kept)))


def test_only_documents_that_may_be_hot_are_counted(make_tables, monkeypatch):
    """The sides are dear to compute; those of other documents are not computed a second time."""
    seen, grids = [], grid.grids
    monkeypatch.setattr(grid, "grids", lambda left, right, *rest: seen.extend((left, right)) or grids(left, right, *rest))
    t = _crowded_tables(make_tables)
    plain, dealt = (revenue_mart.revenue_mart(t, deal_hot_documents=x) for x in (False, True))
    assert multiset(plain) == multiset(dealt) and plain.count() > 0
    assert [side.count() for side in seen] == [0, 0]


def test_hot_documents_are_dealt_as_if_all_were_counted(make_tables, monkeypatch):
    crowded, grids, seen = revenue_mart.crowded, grid.grids, []

    def small(left, right, on, block):
        seen.append(grids(left, right, on, 2))
        return seen[-1]

    monkeypatch.setattr(grid, "grids", small)
    t = _crowded_tables(make_tables, 2)
    plain, marts = revenue_mart.revenue_mart(t, deal_hot_documents=False), []
    for cut in (lambda tables, cfg: tables, lambda tables, cfg: crowded(tables, cfg, 2)):
        monkeypatch.setattr(revenue_mart, "crowded", cut)
        marts.append(revenue_mart.revenue_mart(t, deal_hot_documents=True))
    assert multiset(seen[0]) == multiset(seen[1]) and seen[0].count() == 3
    assert multiset(marts[0]) == multiset(marts[1]) == multiset(plain)


@pytest.fixture
def repeated_rows(spark):
    return spark.createDataFrame(
        [("a", None, 1.5)] * 3 + [(None, "a", 1.5), ("a", "b", None), ("b", None, float("nan")), ("b", None, float("nan")), (None, None, None), (None, None, None), ("c", "d", 2.0)],
        "x string, y string, z double",
    )


def test_full_row_duplicates(repeated_rows):
    plain = aggregates.duplicate_report(repeated_rows)
    found = aggregates.full_row_duplicates(repeated_rows)
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and plain.count() == 3
    assert aggregates.full_row_duplicates(repeated_rows.limit(0)).count() == 0


def test_rows_with_the_same_fingerprints_are_told_apart(repeated_rows):
    clash = (F.lit(1).cast("long"), F.lit(2).cast("long"))
    found = aggregates.full_row_duplicates(repeated_rows, prints=clash)
    assert sorted(map(str, found.collect())) == sorted(map(str, aggregates.duplicate_report(repeated_rows).collect()))


def test_only_fingerprints_and_repeated_rows_are_shuffled(spark, conf):  # noqa: F811
    conf({"spark.sql.adaptive.enabled": "false"})
    df = spark.range(0, 50_000, 1, 4).selectExpr("id % 49900 AS k", "repeat(string(id % 49900), 20) AS wide")
    report = aggregates.full_row_duplicates(df)
    assert report.count() == 100
    plan = report._jdf.queryExecution().executedPlan()
    report._jdf.queryExecution().executedPlan().execute().count()
    seen = []

    def walk(node):
        if node.nodeName() == "Exchange":
            seen.append((node.metrics().apply("shuffleRecordsWritten").value(), "wide" in node.outputPartitioning().toString()))
        for child in [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(plan)
    assert [n for n, whole in seen if whole and n] and max(n for n, whole in seen if whole) <= 400
