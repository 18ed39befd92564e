"""Document tables stored by document: bucketed and sorted by the normalised key.

Lines and headers stored so with the same number of buckets are aggregated by
document and joined without an exchange.  The key columns are stored as well, so the
plans join on what the buckets were made from, and company filters on the trimmed
company reach the scan.

A bucket is read by one task, so a document that fills a bucket many times its share
is better joined with exchanges, which adaptive execution divides.  The layout records
the rows of the fullest bucket; a table whose buckets are too uneven is opened
without them, with the same rows and columns.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.keys import KEY, with_document_key
from ledgerloom.sources.sinks import remove

#: A bucket may hold so many times the mean.
UNEVEN = 4.0
_LAYOUT = "_layout"
_SAID = "buckets int, rows long, most long, partitions string, schema string"


class UnlikeLayouts(ValueError):
    """Tables to be joined have different numbers of buckets."""


@dataclass(frozen=True)
class Layout:
    buckets: int
    rows: int
    #: Rows of the fullest bucket.
    most: int

    @property
    def even(self) -> bool:
        return self.most * self.buckets <= UNEVEN * max(1, self.rows)


def _name(path: str, buckets: int) -> str:
    return f"by_document_{zlib.crc32(path.encode()):08x}_{buckets}"


def _bucket(buckets: int) -> Column:
    # Spark's own bucket of a row.
    return F.pmod(F.hash(*KEY), F.lit(buckets))


def store_by_document(df: DataFrame, path: str, buckets: int, partition_by: tuple[str, ...] = ()) -> Layout:
    """Replace the table at ``path`` by the rows of ``df``, with the document key, in buckets.

    Rows are first brought together by key, in parts of even size: a hot document
    is written by several tasks, into several files of its bucket.  ``df`` must not read
    the table it replaces.
    """
    spark = df.sparkSession
    keyed = with_document_key(df)
    remove(spark, path)
    name = _name(path, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = keyed.hint("rebalance", *KEY).write.format("parquet").option("path", path).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, *KEY).sortBy(*KEY).saveAsTable(name)
    counts = spark.table(name).groupBy(_bucket(buckets).alias("bucket")).agg(F.count("*").alias("n"))
    rows, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    layout = Layout(buckets, rows, most)
    said = spark.createDataFrame([(buckets, rows, most, ",".join(partition_by), spark.table(name).schema.json())], _SAID)
    said.coalesce(1).write.mode("overwrite").json(f"{path}/{_LAYOUT}")
    return layout


def layout_of(spark: SparkSession, path: str) -> tuple[Layout, tuple[str, ...], StructType]:
    """The layout of a stored table, the columns it is partitioned by, and its schema."""
    row = spark.read.schema(_SAID).json(f"{path}/{_LAYOUT}").first()
    partitions = tuple(p for p in row.partitions.split(",") if p)
    return Layout(row.buckets, row.rows, row.most), partitions, StructType.fromJson(json.loads(row.schema))


def open_by_document(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``store_by_document`` wrote, in this or another session.

    The files are declared to the session's catalogue under a name made from the path.
    """
    layout, partitions, schema = layout_of(spark, path)
    if not layout.even:
        return spark.read.schema(schema).parquet(path)
    name = _name(path, layout.buckets)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parted = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
        key = ", ".join(KEY)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {parted} "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {layout.buckets} BUCKETS LOCATION '{path}'"
        )
        if partitions:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def require_alike(spark: SparkSession, *paths: str) -> None:
    """Fail if tables differ in their number of buckets: joins of them would need an exchange."""
    found = {path: layout_of(spark, path)[0].buckets for path in paths}
    if len(set(found.values())) > 1:
        raise UnlikeLayouts(f"numbers of buckets differ: {found}")


def forget(spark: SparkSession, path: str) -> None:
    """Remove the table and its entry in the catalogue."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path, layout_of(spark, path)[0].buckets)}")
    remove(spark, path)
