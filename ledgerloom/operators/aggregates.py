"""Aggregations the plans share.  All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.reduction import likely_in


def sum_max(
    df: DataFrame, keys: list[str], sums: dict[str, Column], maxima: list[str]
) -> DataFrame:
    """Group by ``keys``: named sums, given as aggregates, and maxima of columns."""
    return df.groupBy(*keys).agg(
        *[total.alias(name) for name, total in sums.items()],
        *[F.max(name).alias(name) for name in maxima],
    )


def filtered_max(df: DataFrame, where: Column, keys: list[str], value: str) -> DataFrame:
    return df.filter(where).groupBy(*keys).agg(F.max(value).alias(value))


def with_copies(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Distinct rows of ``columns`` and how often each occurs.

    Joining this instead of the table itself and multiplying sums by the count
    gives the same sums, and repeated rows cannot multiply the rows of a join.
    """
    return df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count("*").alias(name))


def earliest_value(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, nulls: str = "ignore"
) -> DataFrame:
    """The value of the row that is first by ``order``; ties go to the smallest value.

    ``nulls="ignore"`` leaves out rows without an order; a group with no other
    rows gets NULL.  ``nulls="first"`` puts those rows first.  An aggregate, so
    a handful of groups still runs in parallel (a window would put each group
    into one task).
    """
    pair = F.struct(F.col(order), F.col(value))
    if nulls == "ignore":
        pair = F.when(F.col(order).isNotNull(), pair)
    elif nulls != "first":
        raise ValueError(f"nulls must be 'ignore' or 'first', not {nulls!r}")
    first = df.groupBy(*keys).agg(F.min(pair).alias("__first"))
    return first.select(*keys, F.col(f"__first.{value}").alias(name))


def dense_ranks(df: DataFrame, group: str, measure: str, name: str) -> DataFrame:
    """Dense rank of ``measure``, largest first, inside each group.

    Ranks are computed on the distinct (group, measure) pairs and joined back.
    Where the measure counts rows, a group has few distinct values (n of them
    need about n*n/2 rows), so no window partition grows with the group.
    """
    pairs = df.select(F.col(group).alias("__group"), F.col(measure).alias("__measure")).distinct()
    order = Window.partitionBy("__group").orderBy(F.desc("__measure"))
    ranked = pairs.withColumn(name, F.dense_rank().over(order))
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col(measure).eqNullSafe(F.col("__measure"))
    return df.join(ranked, same, "inner").drop("__group", "__measure")


def duplicate_report(df: DataFrame, keys: list[str] | None = None, name: str = "count") -> DataFrame:
    """Keys (by default whole rows) that occur more than once."""
    counted = with_copies(df, keys or df.columns, name)
    return counted.filter(F.col(name) > 1)


def fingerprint(df: DataFrame, seed: int = 0) -> Column:
    """64 bits of a row's content; NULLs count by their place."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    blanks = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(F.lit(seed), blanks, *columns)


def full_row_duplicates(
    df: DataFrame, name: str = "count", prints: tuple[Column, Column] | None = None
) -> DataFrame:
    """Rows that occur more than once in all columns.

    Two fingerprints of each row, 16 bytes, are counted first.  Only rows whose
    fingerprints repeat are shuffled and compared in full, so different
    rows with the same fingerprints are told apart.  ``df`` is read twice: store it
    first where it is dear to compute.
    """
    first, second = prints or (fingerprint(df), fingerprint(df, 1))
    marked = df.withColumns({"__first": first, "__second": second})
    repeated = with_copies(marked, ["__first", "__second"], "__rows").filter("__rows > 1")
    likely = likely_in(marked, repeated, ["__first", "__second"])
    return duplicate_report(likely.drop("__first", "__second"), name=name)
