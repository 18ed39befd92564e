"""Bind stored tables to declared schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructType

from ledgerloom import schemas
from ledgerloom.functions.columns import text_of
from ledgerloom.operators.keys import KEY
from ledgerloom.sources.by_document import open_by_document


class SchemaMismatch(ValueError):
    """A stored table lacks a declared column."""


def conform(df: DataFrame, schema: StructType, name: str = "table") -> DataFrame:
    """Keep the declared columns, in order, with their declared types, and a stored document key.

    Column pruning reaches the scan.  A time part of ``docdate`` is cut here,
    once, so that later comparisons are between days.  A date that is stored as text is
    kept as text beside it, for filters that reach the scan (``since``).
    """
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"{name} has no column {', '.join(missing)}")
    stored = {field.name: field.dataType for field in df.schema}
    columns = []
    for field in schema:
        column = F.col(f"`{field.name}`")
        if stored[field.name] != field.dataType:
            column = column.cast(field.dataType).alias(field.name)
        columns.append(column)
    if {"cmpcode", *KEY} <= {*df.columns}:
        columns += KEY
    for field in schema:
        if isinstance(field.dataType, DateType) and isinstance(stored[field.name], StringType):
            columns.append(F.col(f"`{field.name}`").alias(text_of(field.name)))
    return df.select(*columns)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Scan a stored table; with a schema only the declared columns are read."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df if schema is None else conform(df, schema, path)


# Quotes are doubled inside quoted fields, as spreadsheets write them.
_CSV = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    null_text: str = "",
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header line, a file or a folder of files; a malformed line fails.

    The schema is declared, so nothing is scanned to infer it.  Quoted fields may
    hold quotes, commas and line breaks; ``multi_line=False`` lets Spark split a
    large file whose fields hold no line breaks.  ``null_text`` stands for NULL: by
    default a blank field, which cannot be told from empty text.
    """
    options = {
        **_CSV,
        "multiLine": str(multi_line).lower(),
        "mode": "FAILFAST",
        "nullValue": null_text,
        "enforceSchema": "false",
        # Fields that a query does not ask for are checked as well.
        "columnPruning": "false",
    }
    return spark.read.schema(schema).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, null_text: str = "") -> None:
    """CSV that ``read_csv`` with the same ``null_text`` reads back.

    Text equal to ``null_text`` comes back as NULL: with the default, empty text.
    """
    df.write.options(**_CSV, nullValue=null_text, emptyValue='""' if null_text else "").csv(path)


class DocumentTables:
    """The inputs of the plans, by name.

    Each is a frame or a function that gives one.  A table is bound, and its
    schema checked, when a plan first asks for it.
    """

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        unknown = sorted(set(sources) - set(schemas.ALL))
        if unknown:
            raise ValueError(f"no such table: {', '.join(unknown)}")
        self._sources = sources
        self._bound: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in schemas.ALL:
            raise AttributeError(name)
        if name not in self._bound:
            if name not in self._sources:
                raise SchemaMismatch(f"table {name} was not given")
            source = self._sources[name]
            frame = source if isinstance(source, DataFrame) else source()
            self._bound[name] = conform(frame, schemas.ALL[name], name)
        return self._bound[name]

    @classmethod
    def load(
        cls, spark: SparkSession, paths: dict[str, str | tuple[str, str]], fmt: str = "parquet"
    ) -> "DocumentTables":
        """Tables stored under ``paths``, each a path or (path, format).

        A path that ends in ``.csv`` is read as CSV; a folder of CSV files is
        given as ``(path, "csv")``, a table stored by document as ``(path, "by_document")``.
        """

        def source(name: str, path: str, kind: str) -> Callable[[], DataFrame]:
            if kind == "csv" or path.endswith(".csv"):
                return lambda: read_csv(spark, path, schemas.ALL[name])
            if kind == "by_document":
                return lambda: open_by_document(spark, path)
            return lambda: read_table(spark, path, fmt=kind)

        given = {name: (path, fmt) if isinstance(path, str) else path for name, path in paths.items()}
        return cls(**{name: source(name, *at) for name, at in given.items()})
