"""Client keys from the client master and its cross-reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.columns import number_prefix, to_integer
from ledgerloom.operators.aggregates import dense_ranks
from ledgerloom.sources.tables import DocumentTables

PARENT = "client_ultimate_parent_id"
NAME = "global_ultimate_business_name"
#: Stand-in keys of clients without a code.
STAND_INS = 10_000


def client_key(site: Column, code: Column) -> Column:
    return F.concat(number_prefix(site), F.lit("-"), code.cast("string"))


def parent_counts(tables: DocumentTables) -> DataFrame:
    """Cross-reference codes per (parent, name).

    Codes are counted per client and site first; the joined rows themselves are
    never built.  The site keeps the counts apart from the join key, so that the
    join has an exchange on both sides and Spark can divide a hot client.  Clients
    without a code join nothing: they get a stand-in key, made from their content, that no
    code can be and that deals them over all tasks.
    """
    counts = tables.client_xref.filter("m_code is not null").groupBy(F.col("m_code").alias("code"), "site_id").agg(
        F.count("c_code").alias("codes")
    )
    counts = counts.select(F.concat(F.lit("="), "code").alias("xref_code"), "codes")
    alone = F.concat(F.lit("-"), F.pmod(F.xxhash64(PARENT, NAME), F.lit(STAND_INS)).cast("string"))
    own = F.coalesce(F.concat(F.lit("="), "m_code"), alone)
    joined = tables.client_master.select(PARENT, NAME, own.alias("own_code")).join(
        counts, F.col("own_code") == F.col("xref_code"), "left"
    )
    return joined.groupBy(
        F.col(PARENT).alias("parent_id"), F.col(NAME).alias("parent_name")
    ).agg(F.coalesce(F.sum("codes"), F.lit(0).cast("long")).alias("parent_row_count"))


def ranked_parents(tables: DocumentTables) -> DataFrame:
    """Names of each parent ranked by count; equal counts share a rank."""
    return dense_ranks(parent_counts(tables), "parent_id", "parent_row_count", "parent_row_rank")


def client_keys(
    tables: DocumentTables, dominant_only: bool = False, strict: bool = True
) -> DataFrame:
    """Distinct client, parent, key and name.

    Ranking does not change this result, so it is not computed by default.
    ``dominant_only=True`` keeps only names of rank 1 in their parent (a client
    without a parent is kept when its name leads that group).
    ``strict=False`` turns codes that are no numbers into NULL instead of failing.

    The left join is split: an inner join, whose hot keys Spark can divide on
    either side, and an anti join for clients without cross-reference.
    """
    master = tables.client_master.select("m_code", PARENT, NAME).distinct()
    if dominant_only:
        leading = ranked_parents(tables).filter("parent_row_rank = 1")
        same = F.col(PARENT).eqNullSafe(F.col("parent_id")) & F.col(NAME).eqNullSafe(
            F.col("parent_name")
        )
        master = master.join(leading, same, "left_semi")
    keys = tables.client_xref.select(
        F.col("m_code").alias("xref_code"),
        client_key(F.col("site_id"), F.col("c_code")).alias("ClientKey"),
    ).distinct()
    linked = F.col("m_code") == F.col("xref_code")
    matched = master.join(keys, linked, "inner").select(master["*"], "ClientKey")
    clients = tables.client_xref.select(F.col("m_code").alias("xref_code"))
    without = master.filter("m_code is not null").join(clients, linked, "left_anti")
    unmatched = without.unionByName(master.filter("m_code is null")).withColumn(
        "ClientKey", F.lit(None).cast("string")
    )
    return matched.unionByName(unmatched).select(
        to_integer(F.col("m_code"), strict).alias("m_code"),
        to_integer(F.col(PARENT), strict).alias(PARENT),
        "ClientKey",
        NAME,
    ).distinct()
