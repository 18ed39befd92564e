"""Keep the rows whose company is on a list that is itself a table.

A semi-join.  Where the facts are partitioned by company and the list is a filtered
table, Spark prunes partitions at run time by the companies that it finds on the list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.lookups import is_small


def listed(df: DataFrame, companies: DataFrame | None, company: Column, trimmed: bool = False) -> DataFrame:
    """The rows of ``df`` whose ``company`` is in the first column of ``companies``; all rows without a list.

    Nothing repeats a row, however often the list names its company; NULL is never on it.
    ``trimmed`` compares listed codes without surrounding spaces.  The list is broadcast
    within the session's threshold, and joined in the ordinary way beyond it.
    """
    if companies is None:
        return df
    code = F.col(f"`{companies.columns[0]}`")
    codes = companies.select((F.trim(code) if trimmed else code).alias("__listed")).distinct()
    if is_small(companies):
        codes = F.broadcast(codes)
    return df.join(codes, company == F.col("__listed"), "left_semi")
