"""From raw documents to packed batches: five stages, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, neardup, packing, quality, toxicity
from ledgerloom.llm.queries import cycled_weights

#: The stages as a whole are not SQL: a trained toxicity score and minhashes are among them.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands; empty and NULL texts fail."""
    return quality.keep_good(docs)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7, learned from the labels of those here."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group linked by 0.8 of its five-word shingles."""
    return neardup.drop_near_duplicates(docs, neardup.NearDup(percent=80, half_keys=9, least_equal=30))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weighted 3, 1, 2, repeating, to 1.5 times all words, none read more than twice."""
    return mixing.mixed_documents(docs, cycled_weights(docs), share=1.5, max_epochs=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a batch of at most 16,384 words for every reading."""
    return packing.pack(docs, budget=16_384, buckets=16)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage keeps is written to the warehouse folder, which a cluster shares, and
    removed once the next stage is written; the last one's rows stay for the caller. If a
    stage fails nothing stays.
    """
    root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_pipeline/{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    try:
        for name, stage in STAGES:
            path = f"{root}/{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                _remove(spark, before)
            before = path
    except BaseException:
        _remove(spark, root)
        raise
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
