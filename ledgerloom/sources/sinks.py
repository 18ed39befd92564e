"""Write results and check what was written."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerloom.operators.aggregates import fingerprint

# Characters that some table formats reject in column names.
UNSAFE_CHARACTERS = " ,;{}()\n\t="


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Replace unsafe characters in column names by underscores."""
    table = str.maketrans({character: "_" for character in UNSAFE_CHARACTERS})
    names = [name.translate(table) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"sanitized column names collide: {', '.join(clashes)}")
    return df.toDF(*names)


def _stored_schema(spark: SparkSession, path: str, fmt: str):
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException:
        return None


class ChangedType(ValueError):
    """A column would change its type in a table that keeps its schema."""


def _reject_changed_types(df: DataFrame, old) -> None:
    new = {field.name.lower(): field.dataType for field in df.schema}
    changed = [f.name for f in old if new.get(f.name.lower(), f.dataType) != f.dataType]
    if changed:
        raise ChangedType(f"stored with another type: {', '.join(changed)}")


def overwrite(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    evolve_schema: bool = False,
    partition_by: tuple[str, ...] = (),
    rebalance: bool = False,
) -> None:
    """Replace the table at ``path``.

    A table of files is written beside the old one and takes its place when it is
    complete (``swap_in``): a job that fails leaves the old table as it was, and
    ``df`` may read the table that it replaces.

    ``rebalance`` shuffles once more so that files come out of even size, also
    where one partition value holds most rows.

    With ``evolve_schema`` columns that only the old table has stay in the
    schema, filled with NULL.  Delta does this itself; for file formats the
    missing columns are added to the frame, and a column whose type differs from
    the stored one is rejected.
    """
    writer_options = {}
    if evolve_schema and fmt == "delta":
        writer_options["mergeSchema"] = "true"
    elif evolve_schema:
        old = _stored_schema(df.sparkSession, path, fmt) or []
        _reject_changed_types(df, old)
        known = {name.lower() for name in df.columns}
        extra = [
            F.lit(None).cast(field.dataType).alias(field.name)
            for field in old
            if field.name.lower() not in known
        ]
        df = df.select("*", *extra)
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format(fmt).options(**writer_options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt not in FILE_FORMATS:
        writer.save(path)
        return
    spark = df.sparkSession
    recover(spark, path)
    beside = _beside(path, "new")
    try:
        writer.save(beside)
        swap_in(spark, beside, path)
    finally:
        remove(spark, beside)


# Formats whose tables are folders of files and nothing else.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def _beside(path: str, kind: str) -> str:
    """A folder next to a table; scans of the parent pass over its name."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{kind}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


class SwapFailed(OSError):
    """A finished table could not take the place of the old one."""


def swap_in(spark: SparkSession, beside: str, path: str) -> None:
    """Move a finished table to ``path``; the table there is set aside first and removed last.

    Between the two moves there is no table at ``path``; ``recover`` ends a swap that was
    interrupted there.
    """
    new, files = _files(spark, beside)
    target, aside = _files(spark, path)[0], _files(spark, _beside(path, "old"))[0]
    replaced = files.exists(target)
    if replaced and not files.rename(target, aside):
        raise SwapFailed(f"cannot set aside {path}")
    files.mkdirs(target.getParent())
    if not files.rename(new, target):
        if replaced:
            files.rename(aside, target)
        raise SwapFailed(f"cannot move the new table to {path}")
    if replaced:
        files.delete(aside, True)


def recover(spark: SparkSession, path: str) -> bool:
    """Put the old table back if a swap was interrupted; whether there was one."""
    target, files = _files(spark, path)
    parent, _, name = path.rstrip("/").rpartition("/")
    if files.exists(target) or not files.exists(target.getParent()):
        return False
    found = files.globStatus(_files(spark, f"{parent}/_{name}-old-*")[0]) or []
    aside = [status.getPath() for status in found]
    return len(aside) == 1 and files.rename(aside[0], target)


@dataclass(frozen=True)
class Checksum:
    """What a multiset of rows comes to, whatever their order: their number and two sums of row hashes modulo a prime."""

    rows: int
    first: int
    second: int


#: 2**61 - 1.
_PRIME = (1 << 61) - 1


def _sums(df: DataFrame) -> list[Column]:
    named = df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    sums = [
        F.coalesce(F.sum(F.pmod(fingerprint(named, seed), F.lit(_PRIME)).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
        for seed in (2, 3)
    ]
    return [F.count(F.lit(1)).alias("rows"), sums[0].alias("first"), sums[1].alias("second")]


def _checksum(values: dict) -> Checksum:
    return Checksum(values["rows"], int(values["first"]) % _PRIME, int(values["second"]) % _PRIME)


def checksum(df: DataFrame) -> Checksum:
    """Of all rows, in one pass; columns count by name, not by place."""
    return _checksum(df.agg(*_sums(df)).first().asDict())


class ContentMismatch(ValueError):
    """A stored table does not hold the rows that were written."""


def overwrite_checked(df: DataFrame, path: str, fmt: str = "parquet", rebalance: bool = False, **options) -> Checksum:
    """``overwrite``, and compare what was written with what the table holds.

    The rows are summed while they are written, so ``df`` runs once and may hold values
    that another run would round differently; the stored table is read once.
    """
    seen = Observation()
    if rebalance:
        df = df.hint("rebalance", *options.get("partition_by", ()))
    overwrite(df.observe(seen, *_sums(df)), path, fmt, **options)
    written = _checksum(seen.get)
    require_content(df.sparkSession, path, written, fmt, df.columns)
    return written


def require_content(spark: SparkSession, path: str, expected: Checksum, fmt: str = "parquet", columns: list[str] | None = None) -> None:
    """Fail unless the stored rows come to ``expected``: a changed cell shows although the number of rows is the same."""
    stored = read_back(spark, path, fmt)
    found = checksum(stored.select(*[f"`{c}`" for c in columns]) if columns else stored)
    if found != expected:
        raise ContentMismatch(f"{path} holds {found}, not {expected}")


def read_back(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def written_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Row count of a sink, the check after a write."""
    return read_back(spark, path, fmt).count()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for intermediate data in a folder that all executors share.

    It lies in ``spark.checkpoint.dir``, or beside the tables of the warehouse
    where that is unset.  A folder without a scheme lies in the default file system,
    as Spark reads that setting; the driver resolves it for all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    folder, files = _files(spark, root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch")
    return f"{files.makeQualified(folder).toString().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
