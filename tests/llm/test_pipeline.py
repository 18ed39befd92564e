from __future__ import annotations

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from ledgerloom.llm import quality, queries as llm
from tests.compare import connect, difference, spark_rows, sql_rows
from tests.llm.test_neardup import shingles

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows after each stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR).checkpoint()
        out.append((name, docs))
    return dict(out)


def test_stages(spark, kept):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name in ("quality_rules", "toxicity", "near_duplicates", "mixing"):
        assert kept[name].schema == docs.schema
    good = {r.doc_id for r in docs.collect() if quality.accepted(quality.measure(r.text))}
    assert {r.doc_id for r in kept["quality_rules"].collect()} == good
    assert 0 < kept["toxicity"].count() <= len(good)
    rest = [shingles(r.text) for r in kept["near_duplicates"].collect()]
    assert not [1 for k, a in enumerate(rest) for b in rest[:k] if 100 * len(a & b) >= 80 * len(a | b)]
    assert kept["packing"].count() == kept["mixing"].count()


def test_run_and_registration(spark, kept):
    assert corpus_pipeline.run(spark, SF_DIR).count() == kept["packing"].count()
    names = set(queries())
    assert "pipeline" in names
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(oracle_sql()) <= names


def test_empty(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_sql(spark, name):
    names, rows = spark_rows(queries()[name](spark, SF_DIR))
    sql_names, expected = sql_rows(connect(SF_DIR), oracle_sql()[name])
    assert names == sql_names
    assert rows == expected, difference(rows, expected)
