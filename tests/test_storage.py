"""Staged and checked overwrites, text dates, tables partitioned by company."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.plans import ar_mart, revenue_mart
from ledgerloom.sources import sinks
from ledgerloom.sources.tables import DocumentTables
from tests import messy
from tests.test_operators import multiset
from tests.test_plans import conf, explain, scans  # noqa: F401


def folders(path):
    return sorted(os.listdir(os.path.dirname(path)))


def test_a_failed_job_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(5), path)
    broken = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.overwrite(broken, path)
    assert sinks.written_rows(spark, path) == 5 and folders(path) == ["t"]


def test_a_frame_may_read_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(10), path)
    for left in (5, 3, 2):
        own = sinks.read_back(spark, path)
        sinks.overwrite(own.filter(F.col("id") % 2 == 0).select(F.expr("id div 2 AS id")), path)
        assert sinks.written_rows(spark, path) == left
    assert folders(path) == ["t"]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_new_and_partitioned_tables(spark, tmp_path, fmt):
    path = str(tmp_path / "deep" / "er" / "t")
    frame = spark.range(6).selectExpr("id", "concat('p', id % 2) AS p")
    for _ in range(2):
        sinks.overwrite(frame, path, fmt, partition_by=("p",), rebalance=True)
    assert sinks.read_back(spark, path, fmt).count() == 6 and {"p=p0", "p=p1"} <= set(os.listdir(path))


def test_an_interrupted_swap_is_ended(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(5), path)
    os.rename(path, str(tmp_path / "_t-old-1"))
    assert sinks.recover(spark, path) and sinks.written_rows(spark, path) == 5
    assert not sinks.recover(spark, path)
    os.rename(path, str(tmp_path / "_t-old-1"))
    # The next overwrite starts from the old table: its schema evolves.
    sinks.overwrite(spark.range(2).select(F.col("id").alias("n")), path)
    assert folders(path) == ["t"] and sinks.written_rows(spark, path) == 2


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", None, 1.5, 1), (None, "a", 1.5, 2), ("b", "c", None, 3), ("b", "c", None, 3), (None, None, float("nan"), None)],
        "x string, y string, z double, n int",
    )


def test_checksum_is_of_the_multiset(spark, rows):
    base = sinks.checksum(rows)
    assert base.rows == 5 and base == sinks.checksum(rows.orderBy(F.desc("n")).repartition(3).select("n", "z", "x", "y"))
    changed = rows.withColumn("n", F.when(F.col("n") == 1, 7).otherwise(F.col("n")))
    swapped = rows.select(F.col("y").alias("x"), F.col("x").alias("y"), "z", "n")
    halved = rows.distinct().unionByName(rows.filter("n = 1"))
    renamed = rows.toDF("y", "x", "z", "n")
    for other in (changed, swapped, halved, renamed, rows.limit(4)):
        assert sinks.checksum(other) != base
    assert sinks.checksum(rows.limit(0)) == sinks.Checksum(0, 0, 0)


def test_a_changed_cell_is_found(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    written = sinks.overwrite_checked(rows, path, rebalance=True)
    assert written == sinks.checksum(rows)
    sinks.require_content(spark, path, written)
    sinks.overwrite(rows.withColumn("y", F.when(F.col("y") == "c", "d").otherwise(F.col("y"))), path)
    assert sinks.written_rows(spark, path) == written.rows
    with pytest.raises(sinks.ContentMismatch):
        sinks.require_content(spark, path, written)


def test_checked_overwrite_with_kept_columns(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(rows.withColumn("old", F.lit(1)), path)
    sinks.overwrite_checked(rows, path, evolve_schema=True)
    assert "old" in sinks.read_back(spark, path).columns


@pytest.fixture(scope="module")
def as_text(spark, make, tmp_path_factory):
    """Tables whose dates are text, with what a cast accepts besides ISO days."""
    folder = tmp_path_factory.mktemp("as_text")
    given = messy.tables(4)
    paths = {}
    for name in schemas.ALL:
        paths[name] = str(folder / name)
        frame = make(name, given[name])
        if name == "dochead":
            day, n = F.col("docdate").cast("string"), F.pmod(F.hash("docnum"), F.lit(4))
            text = F.when(n == 0, F.concat(F.lit(" "), day)).when(n == 1, F.concat(day, F.lit(" 10:11:12"))).when(n == 2, F.concat(F.lit("+"), day)).otherwise(day)
            frame = frame.withColumn("docdate", text)
        frame.write.parquet(paths[name])
    plain = DocumentTables(**{name: make(name, given[name]) for name in schemas.ALL})
    return plain, DocumentTables.load(spark, paths)


@pytest.mark.parametrize("build", [ar_mart.ar_mart, revenue_mart.revenue_mart])
def test_the_bound_of_a_text_date_reaches_the_scan(as_text, build):
    plain, text = as_text
    pushed = [filters for filters, _ in scans(explain(build(text)), "dochead")]
    assert any("GreaterThanOrEqual(docdate,20" in f and "LessThan(docdate,0)" in f for f in pushed)
    want = multiset(build(plain))
    assert multiset(build(text)) == want and want


def test_company_lists_prune_partitions(spark, make, tmp_path):
    given = messy.tables(6)
    paths = {name: str(tmp_path / name) for name in schemas.ALL}
    for name, path in paths.items():
        sinks.overwrite(make(name, given[name]), path, partition_by=("cmpcode",) if name in ("docline", "dochead") else ())
    t = DocumentTables.load(spark, paths)
    plan = explain(ar_mart.ar_mart(t))
    blocks = [b for b in plan.split("\n\n") if re.search(r"Location: .*/(docline|dochead)\b", b)]
    kept = [re.search(r"PartitionFilters: \[(.*)\]", b).group(1) for b in blocks]
    assert len(kept) >= 3 and all("cmpcode" in k and (" IN (" in k or " INSET " in k) for k in kept)
    plain = DocumentTables(**{name: make(name, given[name]) for name in schemas.ALL})
    assert multiset(ar_mart.ar_mart(t)) == multiset(ar_mart.ar_mart(plain))


def _partitioned(spark, make, tmp_path, given):
    paths = {name: str(tmp_path / name) for name in schemas.ALL}
    for name, path in paths.items():
        sinks.overwrite(make(name, given[name]), path, partition_by=("cmpcode",) if name in ("docline", "dochead") else ())
    return DocumentTables.load(spark, paths)


def test_listed_companies_prune_at_run_time(spark, make, tmp_path):
    t = _partitioned(spark, make, tmp_path, messy.tables(6))
    one = t.dochead.groupBy("cmpcode").count().orderBy(F.desc("count"), "cmpcode").first()["cmpcode"]
    codes = spark.createDataFrame([(one, "in"), (one, "in"), (f"{one} ", "in"), (None, "in"), ("MAI", "out")], "code string, state string")
    codes.write.parquet(str(tmp_path / "codes"))
    companies = spark.read.parquet(str(tmp_path / "codes")).filter("state = 'in'").select("code")
    got = ar_mart.ar_mart(t, companies=companies)
    blocks = [b for b in explain(got).split("\n\n") if re.search(r"Location: .*/(docline|dochead)\b", b)]
    assert len(blocks) >= 3 and all("dynamicpruning" in re.search(r"PartitionFilters: \[(.*)\]", b).group(1) for b in blocks)
    want = [r for r in ar_mart.ar_mart(t).collect() if r.cmpcode in (one, f"{one} ")]
    assert want and multiset(got) == multiset(spark.createDataFrame(want, got.schema))


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_listed_companies_of_any_size(spark, make, threshold):
    t = DocumentTables(**{name: make(name, rows) for name, rows in messy.tables(6).items()})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        none = ar_mart.ar_mart(t, companies=t.company.filter("false").select("code"))
        every = ar_mart.ar_mart(t, companies=t.dochead.select("cmpcode"))
        assert none.count() == 0 and multiset(every) == multiset(ar_mart.ar_mart(t))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
