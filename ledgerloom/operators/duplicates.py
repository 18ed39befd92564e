"""Find rows that share a key and give some of them a new one.

Counts per key come from an aggregate that is joined back.  A window over the
key would send every row of one hot key (or of the NULL key) to one task; the
aggregate combines on the map side, and Spark can split a hot join partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.config import REKEY_TYPE

KEY = "_key_global_identifier"
NEW_KEY = "new_key_global_identifier"


def _key_counts(df: DataFrame, key: str, number: str, distinct_numbers: bool) -> DataFrame:
    if not distinct_numbers:
        return df.groupBy(key).agg(
            F.count("*").alias("dup_count"), F.count(number).alias("__numbers")
        )
    pairs = df.groupBy(key, number).agg(F.count("*").alias("__rows"))
    return pairs.groupBy(key).agg(
        F.sum("__rows").alias("dup_count"), F.count(number).alias("__numbers")
    )


def flag_duplicates(
    df: DataFrame,
    key: str = KEY,
    kind: str = "AR_Invoice_Type",
    number: str = "AR_Invoice_Number",
    rekey_type: str = REKEY_TYPE,
    distinct_numbers: bool = False,
    nulls_as_duplicates: bool = True,
) -> DataFrame:
    """Add ``dup_count`` (rows with this key) and ``Flag``.

    ``Flag`` is ``Y`` for rows of the re-key type whose key has more than one
    row and more than one number, else ``N``.  Numbers are counted when not
    NULL; ``distinct_numbers=True`` counts different ones.  Rows without a key
    form one group unless ``nulls_as_duplicates=False``, which leaves each alone.
    """
    counts = _key_counts(df, key, number, distinct_numbers).withColumnRenamed(key, "__key")
    joined = df.join(counts, F.col(key).eqNullSafe(F.col("__key")), "inner")
    if not nulls_as_duplicates:
        alone = F.col(key).isNull()
        joined = joined.withColumns({
            "dup_count": F.when(alone, F.lit(1).cast("long")).otherwise(F.col("dup_count")),
            "__numbers": F.when(alone, F.lit(0).cast("long")).otherwise(F.col("__numbers")),
        })
    flagged = (F.col(kind) == rekey_type) & (F.col("dup_count") > 1) & (F.col("__numbers") > 1)
    return joined.withColumn("Flag", F.when(flagged, F.lit("Y")).otherwise(F.lit("N"))).drop(
        "__key", "__numbers"
    )


def new_key_text(site: Column, number: Column) -> Column:
    """``site-number``; a NULL part prints as ``null``."""
    return F.format_string("%s-%s", site.cast("string"), number.cast("string"))


def rekey_duplicates(
    df: DataFrame,
    key: str = KEY,
    site: str = "AR Billing Site",
    number: str = "AR_Invoice_Number",
    keep_unflagged: bool = False,
    **flag_options,
) -> DataFrame:
    """Rows with a unique key as they are, flagged duplicates under a new key.

    Duplicates that are not flagged are left out; ``keep_unflagged=True`` keeps
    them under their old key.
    """
    flagged = flag_duplicates(df, key=key, number=number, **flag_options)
    renew = F.col("Flag") == "Y"
    kept = flagged if keep_unflagged else flagged.filter((F.col("dup_count") == 1) | renew)
    text = new_key_text(F.col(f"`{site}`"), F.col(f"`{number}`"))
    return kept.withColumn(NEW_KEY, F.when(renew, text).otherwise(F.col(key))).drop(
        "Flag", "dup_count"
    )
