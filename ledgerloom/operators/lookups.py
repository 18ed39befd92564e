"""Joins to lookup tables, by the planned size of the lookup.

Within the session's broadcast threshold: broadcast.  Larger: an ordinary join,
whose hot partitions adaptive execution divides; where the key is known to have few
values (``spread``), the rows of each are spread over salts: the fact row gets a
salt from its own content, the lookup row is repeated once per salt.  The salt is a
function of the row, so a recomputed task makes the same rows.  A lookup of unknown
size is left to Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

SPREAD_LIMIT = 1024**3
SPREAD = 32


def planned_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate of a plan; None where the session does not offer one that holds.

    The estimate does not count the rows that an explode adds.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    if "Generate " in plan.toString():
        return None
    return int(str(plan.stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; negative where broadcasts are off."""
    try:
        return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except AttributeError:
        return -1


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    size = planned_bytes(df)
    return size is not None and size <= (broadcast_limit(df) if limit is None else limit)


class DuplicateLookupKey(ValueError):
    """A lookup that must be unique has a repeated key."""


def require_unique(lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Fail when a key occurs twice.  Runs a job, so it is opt-in."""
    repeated = lookup.groupBy(*[F.col(f"`{k}`") for k in keys]).count().filter("count > 1")
    first = repeated.limit(1).collect()
    if first:
        raise DuplicateLookupKey(f"lookup key occurs {first[0]['count']} times: {first[0].asDict()}")
    return lookup


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    spread_by: tuple[str, ...] = (),
    sized_by: DataFrame | None = None,
    unique: bool = False,
    limit: int | None = None,
    spread: int = 1,
) -> DataFrame:
    """Add the non-key columns of ``lookup`` to ``facts``.

    ``on`` maps fact columns to lookup columns.  Repeated lookup keys repeat the
    fact row; ``unique=True`` rejects them instead.  ``sized_by`` names the table
    that bounds the lookup's rows when the lookup itself is a derived plan.
    ``limit`` replaces the session's threshold.  ``spread`` is the number of salts
    for a key of few values, ``spread_by`` the fact columns a salt is made from (all
    by default).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if unique:
        require_unique(lookup, list(on.values()))
    size = planned_bytes(lookup if sized_by is None else sized_by)
    renamed = {key: f"__lookup_{i}" for i, key in enumerate(on.values())}
    side = lookup.withColumnsRenamed(renamed)
    pairs = [F.col(f"`{fact}`") == F.col(renamed[key]) for fact, key in on.items()]
    drop = list(renamed.values())
    if size is not None and size <= (broadcast_limit(facts) if limit is None else limit):
        side = F.broadcast(side)
    elif spread > 1 and size is not None and size <= SPREAD_LIMIT:
        salt_of = [F.col(f"`{name}`") for name in (spread_by or tuple(facts.columns))]
        facts = facts.withColumn("__salt", F.pmod(F.xxhash64(*salt_of), F.lit(spread)).cast("int"))
        side = side.withColumn("__lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        pairs.append(F.col("__salt") == F.col("__lookup_salt"))
        drop += ["__salt", "__lookup_salt"]
    return facts.join(side, reduce(lambda a, b: a & b, pairs), how).drop(*drop)
