"""Inner join whose hot keys are dealt in a grid.

A key with n rows on one side and m on the other makes n * m rows.  Where both are
many, its left rows are dealt into blocks and its right rows into others, every left
block meets every right block in a place of its own, and no place pairs more
than about a block with a block.  Adaptive execution divides partitions by their bytes;
this divides them by the rows that they will make.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows of a side of one place.
BLOCK = 4096
#: Keys that share a hash share a grid, so the table of grids has no more rows.
SLOTS = 1 << 16


def grids(left: DataFrame, right: DataFrame, on: list[str], block: int = BLOCK) -> DataFrame:
    """(grid_slot, tall, wide): blocks of the left and right side for keys that make more than block * block rows.

    At most ``SLOTS`` rows whatever the number of keys; a key that shares the slot of a hot
    one is dealt like it, to the same result.
    """
    n, m = "__left_rows", "__right_rows"
    counts = [side.groupBy(*on).agg(F.count("*").alias(name)) for side, name in ((left, n), (right, m))]
    hot = counts[0].join(counts[1], on).filter(F.col(n) * F.col(m) > block * block)
    blocks = [F.greatest(F.lit(1), F.ceil(F.col(c) / block)).cast("int") for c in (n, m)]
    return hot.groupBy(F.pmod(F.xxhash64(*on), F.lit(SLOTS)).alias("grid_slot")).agg(
        F.max(blocks[0]).alias("tall"), F.max(blocks[1]).alias("wide")
    )


def dealt(df: DataFrame, on: list[str], dims: DataFrame, own: str, other: str) -> DataFrame:
    """Rows with their place: a block of ``own`` made from their content, repeated for each block of ``other``."""
    placed = df.join(F.broadcast(dims), F.pmod(F.xxhash64(*on), F.lit(SLOTS)) == F.col("grid_slot"), "left")
    row = F.xxhash64(F.lit(7), *[F.col(f"`{c}`") for c in df.columns])
    block = F.pmod(row, F.coalesce(F.col(own), F.lit(1))).cast("int")
    across = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
    return placed.select(df["*"], block.alias(f"__{own}"), across.alias(f"__{other}"))


def grid_join(
    left: DataFrame, right: DataFrame, on: list[str], block: int = BLOCK,
    counted: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """``left.join(right, on)``.  Both sides are read once more, to count the rows of keys.

    Where they are dear to compute, ``counted`` are their rows of the keys that may be hot.
    """
    dims = grids(*(counted or (left, right)), on, block)
    a, b = dealt(left, on, dims, "tall", "wide"), dealt(right, on, dims, "wide", "tall")
    return a.join(b, [*on, "__tall", "__wide"]).drop("__tall", "__wide")
