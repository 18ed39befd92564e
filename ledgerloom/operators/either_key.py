"""Left join on ``key_a = key OR key_b = key`` in one pass, without a nested loop.

Written as an OR, the join has no equality to hash on and Spark compares every
pair of rows.  Here each left row is repeated once for each of its different keys and
joined on that key, so both inputs are read once and either side of a hot key
can be divided.  What is left to settle is which rows matched by neither key: one
aggregate over the joined rows, which are equal in all columns, counts them.  Rows
that matched come out as often as they were paired, and rows without a match once for
each copy, if they missed by every key they have.  The counts depend on content only,
so a repeated task changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Copies of one row that are listed in one array.
COPIES = 4096


def either_key_left_join(
    left: DataFrame, right: DataFrame, key_a: str, key_b: str, right_key: str
) -> DataFrame:
    """``right`` must not share column names with ``left``; no column may be a map."""
    keys = F.array_distinct(F.array_compact(F.array(f"`{key_a}`", f"`{key_b}`")))
    tried = left.select("*", F.posexplode_outer(keys).alias("__place", "__key"))
    paired = tried.join(right, F.col("__key") == F.col(f"`{right_key}`"), "left")
    columns = [F.col(f"`{name}`") for name in (*left.columns, *right.columns)]
    settled = paired.groupBy(*columns).agg(
        F.count("*").alias("__rows"), F.count_if(F.col("__place") == 1).alias("__second")
    )
    first = F.col("__rows") - F.col("__second")
    two_keys = F.coalesce(F.col(f"`{key_a}`") != F.col(f"`{key_b}`"), F.lit(False))
    missed_all = F.when(two_keys, F.least(first, F.col("__second"))).otherwise(F.col("__rows"))
    times = F.when(F.col(f"`{right_key}`").isNull(), missed_all).otherwise(F.col("__rows"))
    return repeated(settled.withColumn("__times", times), "__times").select(*columns)


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says; 0 leaves it out.  Arrays stay short for any number."""
    whole, rest = (F.col(times) / COPIES).cast("int"), (F.col(times) % COPIES).cast("int")
    chunks: Column = F.concat(F.array_repeat(F.lit(COPIES), whole), F.array(rest))
    listed = df.filter(F.col(times) > 0).withColumn("__chunk", F.explode(chunks))
    return listed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__chunk")))).drop("__chunk", "__copy")
