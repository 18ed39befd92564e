"""What the operators share: stored intermediate tables, Arrow batches, gapless ranks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

#: A word is a run of characters other than ASCII white space (fixed by the query contracts).
WORD = r"[^\x20\x09-\x0D]+"
#: Tables with at most so many rows, counted first, may be broadcast.
BROADCAST_ROWS = 200_000
#: Rows of an Arrow batch; texts are long, so fewer than Spark's default.
BATCH_ROWS = 512
_ROW_IN_PARTITION = (1 << 33) - 1
_ROOT = str(Path(__file__).resolve().parents[2])


def stored(df: DataFrame) -> DataFrame:
    """The rows as files in the cluster's checkpoint folder, without their lineage.

    The folder comes from the session (``spark.checkpoint.dir``). Where that is
    unset it lies beside the tables of the warehouse, which a cluster shares.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return df.checkpoint()


def release(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as set it apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def python_workers(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to ``BATCH_ROWS`` unless the session has set a number,
    and let local workers import this package (on a cluster submit it with --py-files).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, found) if x)


def map_batches(
    df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``run`` on each Arrow batch of ``df``, in bounded batches."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield run(part)

    python_workers(df.sparkSession)
    return df.mapInArrow(batches, schema)


def words(text: Column) -> Column:
    """Number of words; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_key(seed: int, id_: Column, text: Column) -> Column:
    """32 hexadecimal digits that shuffle rows: the same for a seed, an id and a text."""
    parts = [F.lit(str(seed)), F.coalesce(id_.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))]
    return F.md5(F.concat_ws("|", *parts))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are few; else as it is."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps; no task sees more than a partition of ``df``.

    ``df`` is stored first, so its partitions stay as they are: rows are counted
    for each group and partition, the counts are summed along the partitions, and
    a row's number is that sum plus its place in its own partition.
    """
    part, place, n, start, local = fresh(df, "partition", "place", "n", "start", "local")
    rows = stored(df).withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()})
    ahead = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*by, part)
        .agg(F.count(F.lit(1)).alias(n))
        .withColumn(start, F.coalesce(F.sum(n).over(ahead), F.lit(0)))
    )
    if by:
        inside = Window.partitionBy(*by, part).orderBy(place)
        rows = rows.withColumn(local, F.row_number().over(inside) - 1)
    else:
        rows = rows.withColumn(local, F.col(place).bitwiseAND(F.lit(_ROW_IN_PARTITION)))
    same = F.col(f"l.{part}") == F.col(f"r.{part}")
    for column in by:
        same &= F.col(f"l.{column}").eqNullSafe(F.col(f"r.{column}"))
    kept = [F.col(f"l.`{column}`") for column in df.columns]
    number = (F.col(f"r.{start}") + F.col(f"l.{local}")).cast("long").alias(name)
    return rows.alias("l").join(starts.alias("r"), same).select(*kept, number)


def numbered_in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows from 0 in the order of columns that together differ in every row."""
    return numbered(df.repartitionByRange(*order).sortWithinPartitions(*order), [], name)


def filtered(docs: DataFrame, text_col: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts ``keep`` accepts, a batch at a time."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        return part.filter(pa.array(keep(part.column(text_col).to_pylist()), pa.bool_()))

    return map_batches(docs, run, docs.schema)
