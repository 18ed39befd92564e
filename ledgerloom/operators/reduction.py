"""Cut a large table down to what a join can match, before anything is shuffled.

The keys of the smaller side are hashed to bits, 64 to a word.  The words are combined
on the map side, there are never more than ``words`` of them, and so they are
broadcast whatever the size of either table.  A row whose bit is not set cannot match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORDS = 1 << 18


def _place(on: list[str], words: int) -> tuple[Column, Column]:
    key = F.xxhash64(*[F.col(f"`{name}`") for name in on])
    return F.pmod(key, F.lit(words)).cast("int"), F.pmod(F.shiftrightunsigned(key, 40), F.lit(64)).cast("int")


def likely_in(df: DataFrame, other: DataFrame, on: list[str], words: int = WORDS) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``other``, and few that do not.

    Of rows whose key does not occur, about n / (64 * words) stay for n keys of
    ``other``: join it afterwards.  ``df`` keeps its partitions.
    """
    word, bit = _place(on, words)
    hashed = other.select(word.alias("__word"), bit.alias("__bit"))
    bits = hashed.groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    joined = df.join(F.broadcast(bits), word == F.col("__word"))
    return joined.filter(F.getbit("__bits", bit) == 1).select(df["*"])
