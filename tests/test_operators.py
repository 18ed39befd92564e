"""Joins, ranks and reports on small frames, against their plain forms."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, lookups
from ledgerloom.operators import either_key
from ledgerloom.operators.either_key import either_key_left_join
from ledgerloom.operators.keys import document_join, with_document_key
from ledgerloom.operators.reduction import likely_in
from ledgerloom.plans import ar_corrections as corrections

KEYS = st.sampled_from(["a", "b", "c", None])
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def multiset(df):
    return Counter(tuple(row) for row in df.collect())


@FEW
@given(
    left=st.lists(st.tuples(st.integers(0, 3), KEYS, KEYS), max_size=8),
    right=st.lists(st.tuples(KEYS, st.sampled_from(["v", "w", None])), max_size=6),
)
def test_either_key_is_or_join(spark, left, right):
    a = spark.createDataFrame(left, "id int, k1 string, k2 string")
    b = spark.createDataFrame(right, "rk string, value string")
    plain = a.join(b, (a.k1 == b.rk) | (a.k2 == b.rk), "left")
    assert multiset(either_key_left_join(a, b, "k1", "k2", "rk")) == multiset(plain)


def test_either_key_cases(spark):
    a = spark.createDataFrame(
        [(1, "a", "z"), (2, "z", "b"), (3, "a", "b"), (4, "z", "z"), (5, "n", None), (6, "d", "z"),
         (7, "a", "a")],
        "id int, k1 string, k2 string",
    )
    b = spark.createDataFrame(
        [("a", "v"), ("b", "w"), ("n", None), ("d", "x"), ("d", "x")], "rk string, value string"
    )
    got = either_key_left_join(a, b, "k1", "k2", "rk").select("id", "rk", "value")
    assert multiset(got) == Counter([
        (1, "a", "v"), (2, "b", "w"), (3, "a", "v"), (3, "b", "w"), (4, None, None),
        (5, "n", None), (6, "d", "x"), (6, "d", "x"), (7, "a", "v"),
    ])


def test_either_key_copies(spark, monkeypatch):
    """Equal rows on both sides, matched, missed, and missed by one key only."""
    monkeypatch.setattr(either_key, "COPIES", 3)
    a = spark.createDataFrame(
        [(1, "a", "z")] * 7 + [(2, "y", "z")] * 8 + [(3, None, None)] * 4 + [(4, "y", None)] * 6 + [(5, "y", "y")] * 3
        + [(6, "z", "b")] * 2, "id int, k1 string, k2 string",
    )
    b = spark.createDataFrame([("a", "v")] * 5 + [("b", None)] + [(None, "n")] * 2, "rk string, value string")
    plain = a.join(b, (a.k1 == b.rk) | (a.k2 == b.rk), "left")
    got = either_key_left_join(a, b, "k1", "k2", "rk")
    assert got.columns == plain.columns
    assert multiset(got) == multiset(plain) and sum(multiset(got).values()) == 35 + 8 + 4 + 6 + 3 + 2


@pytest.mark.parametrize("words", [1, 4, 1 << 12])
def test_likely_in_keeps_every_match(spark, words):
    big = spark.range(4000).selectExpr("string(id) AS k", "id % 7 AS n", "id")
    small = spark.createDataFrame([(str(3 * i), 3 * i % 7) for i in range(30)] + [(None, 1)], "k string, n long")
    kept = likely_in(big, small, ["k", "n"], words)
    assert kept.columns == big.columns
    wanted = multiset(big.join(small, ["k", "n"], "left_semi").select(*big.columns))
    assert sum(wanted.values()) == 30 and not wanted - multiset(kept)
    if words > 1000:
        assert kept.count() < 40
    assert likely_in(big, small.limit(0), ["k", "n"], words).count() == 0


def test_corrections_by_stem_is_or_join(spark):
    mart = spark.createDataFrame(
        [("c", "d", " 1 "), ("c", "d", None), ("c", "d", "-x"), ("c", None, "d-1"), (None, None, None), ("", None, None)],
        "cmpcode string, doccode string, InvoiceNumber string",
    )
    keyed = corrections.with_correction_keys(mart)
    lookup = spark.createDataFrame(
        [(f"{stem}-{field}", value)
         for stem in ("c-d-1", "c-d", "c-d--x", "-c-d", "")
         for field in ("ServiceDeliverySite", "ServiceDeliverySiteInvoiceNumber", "Site")
         for value in ("v", None)] + [(None, "v"), ("ServiceDeliverySite", "v"), ("ServiceDeliverySiteInvoiceNumber", "w")],
        "InterimKey string, FieldValue string",
    )
    either = (F.col(corrections.SITE_KEY) == F.col("InterimKey")) | (
        F.col(corrections.INVOICE_KEY) == F.col("InterimKey")
    )
    expected = multiset(keyed.join(lookup, either, "left"))
    assert multiset(corrections.with_corrections(keyed, lookup)) == expected
    assert sum(expected.values()) > 4


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("size", [0, 100 * 2**20, 2**40, None])
def test_lookup_join_paths_agree(spark, tmp_path, monkeypatch, how, size):
    monkeypatch.setattr(lookups, "planned_bytes", lambda df: size)
    path = str(tmp_path / "lookup")
    spark.createDataFrame(
        [("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, "z")], "code string, n int, name string"
    ).write.parquet(path)
    lookup = spark.read.parquet(path)
    facts = spark.createDataFrame(
        [("a", 1, i) for i in range(40)] + [("b", 2, 0), ("b", 3, 0), (None, 3, 0)],
        "c string, k int, v int",
    )
    plain = facts.join(lookup, (F.col("c") == F.col("code")) & (F.col("k") == F.col("n")), how)
    joined = lookups.lookup_join(facts, lookup, {"c": "code", "k": "n"}, how=how, spread=4)
    assert joined.columns == ["c", "k", "v", "name"]
    assert multiset(joined) == multiset(plain.drop("code", "n"))


def test_lookup_join_spreads_a_hot_key(spark, tmp_path):
    facts = spark.range(1000).selectExpr("'hot' AS c", "id AS v")
    path = str(tmp_path / "lookup")
    spark.createDataFrame([("hot", "x")], "code string, name string").write.parquet(path)
    lookup = spark.read.parquet(path)
    joined = lookups.lookup_join(facts, lookup, {"c": "code"}, limit=0, spread_by=("v",), spread=8)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(id" in plan
    assert joined.filter("name = 'x'").count() == 1000


def test_unique_lookup(spark):
    lookup = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "code string, n int")
    with pytest.raises(lookups.DuplicateLookupKey):
        lookups.require_unique(lookup, ["code"])
    assert lookups.require_unique(lookup, ["code", "n"]).count() == 3
    facts = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(lookups.DuplicateLookupKey):
        lookups.lookup_join(facts, lookup, {"c": "code"}, unique=True)
    with pytest.raises(ValueError):
        lookups.lookup_join(facts, lookup, {"c": "code"}, how="full")


def test_document_key_is_trimmed(spark):
    schema = "cmpcode string, doccode string, docnum string, v int"
    left = with_document_key(spark.createDataFrame([(" A", "B ", "  1", 1)], schema))
    right = with_document_key(spark.createDataFrame([("A", "B", "1 ", 2), ("A", "B", "\t1", 3)], schema))
    keyed = right.select("key_company", "key_code", "key_number", F.col("v").alias("w"))
    assert [row.w for row in document_join(left, keyed).collect()] == [2]


@FEW
@given(rows=st.lists(st.tuples(KEYS, st.one_of(st.none(), st.integers(0, 3))), max_size=12))
def test_dense_ranks(spark, rows):
    df = spark.createDataFrame(rows, "g string, n int")
    plain = df.selectExpr("g", "n", "dense_rank() OVER (PARTITION BY g ORDER BY n DESC) AS r")
    assert multiset(aggregates.dense_ranks(df, "g", "n", "r")) == multiset(plain)


def test_duplicate_report(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 3)], "k string, `odd.name` int")
    assert multiset(aggregates.duplicate_report(df)) == Counter([("a", 1, 2), (None, 3, 2)])
    assert multiset(aggregates.duplicate_report(df, ["k"])) == Counter([("a", 3), (None, 2)])
