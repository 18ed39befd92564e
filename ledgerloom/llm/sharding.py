"""Place rows in shards by descending a weighted hash tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import numbered

_ROOT = ""
_STEPS = float(1 << 53)


@dataclass(frozen=True)
class Tree:
    """Shards as (region, rack, shard, weight)."""

    leaves: tuple[tuple[str, str, int, float], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> Tree:
        """``racks`` in each region, ``shards`` in each rack, numbered from 0, of equal weight."""
        return cls(tuple(
            (f"region{i // (racks * shards)}", f"rack{i // shards}", i, 1.0)
            for i in range(regions * racks * shards)
        ))

    def grown(self) -> Tree:
        """One more shard, in a region of its own: no other node changes its weight."""
        n = 1 + max(shard for _, _, shard, _ in self.leaves)
        return Tree((*self.leaves, (f"region+{n}", f"rack+{n}", n, 1.0)))

    def children(self) -> dict[str, list[tuple[str, float]]]:
        """The children of each node with the weight below them; nodes without weight are left out."""
        weight: dict[str, dict[str, float]] = {}
        for region, rack, shard, own in self.leaves:
            path = [_ROOT, region, f"{region}/{rack}", f"{region}/{rack}/{shard}"]
            for parent, child in zip(path, path[1:], strict=False):
                below = weight.setdefault(parent, {})
                below[child] = below.get(child, 0.0) + own
        return {node: [(c, w) for c, w in below.items() if w > 0] for node, below in weight.items()}


def descend(key: Column, tree: Tree) -> Column:
    """The path region/rack/shard of a key.

    At each node every child draws ``-ln(u) / weight`` with ``u`` hashed from the key
    and the child's name, and the smallest draw wins: a child wins in proportion to
    its weight, and a change of one weight moves rows only to or from that child.
    """
    struct = "struct<name:string,weight:double>"
    table = F.create_map(*[
        part
        for node, below in tree.children().items()
        for part in (
            F.lit(node),
            F.array(*[F.struct(F.lit(c).alias("name"), F.lit(w).alias("weight")) for c, w in below]).cast(f"array<{struct}>"),
        )
    ])

    def draw(child: Column) -> Column:
        u = (F.pmod(F.xxhash64(key, child["name"]), F.lit(1 << 53)) + 1) / F.lit(_STEPS)
        return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))

    node = F.lit(_ROOT)
    for _ in range(3):
        node = F.array_min(F.transform(table[node], draw))["name"]
    return node


def shard(
    docs: DataFrame,
    tree: Tree,
    grown: Tree | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Put every row into a shard of ``tree`` by its id.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32 (of the empty
    text for NULL), law = 'key', region, rack, shard, slot (from 0 without gaps in
    a shard) and grown_shard (the shard in ``grown``; NULL without it). The id and
    the tree alone decide: rows that repeat an id, and all rows without one, share
    a shard. An empty table gives an empty result.

    Scale: placing needs no shuffle; only slots do, and those number the rows of
    each input partition, so a crowded shard is never in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    id_ = F.col(id_col)
    placed = docs.select(
        id_.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.split(descend(id_, tree), "/").alias("path"),
        (F.split_part(descend(id_, grown), F.lit("/"), F.lit(3)) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    ).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("path")[0].alias("region"), F.col("path")[1].alias("rack"),
        F.col("path")[2].cast("int").alias("shard"), "grown_shard",
    )
    return numbered(placed, ["shard"], "slot")
