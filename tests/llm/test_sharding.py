from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from ledgerloom.llm.sharding import Tree, shard


def test_slots_sizes_and_growth(make_docs):
    tree = Tree.even(4, 2, 2)
    rows = [(i, f"täxt {i % 7}") for i in range(4000)] + [(None, None), (None, None), (3, "täxt 3"), (9, "")]
    got = shard(make_docs(rows).repartition(5), tree, tree.grown()).collect()
    assert len(got) == len(rows)
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 16)
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(places) == 1 for places in by_id.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    moved = sum(r.grown_shard == 16 for r in got)
    assert 0.04 < moved / len(got) < 0.08
    assert all(0.7 < len(s) / (len(got) / 16) < 1.3 for s in slots.values())


def test_a_weight_moves_rows_only_to_its_subtree(make_docs):
    light = Tree((("e", "r1", 0, 1.0), ("e", "r2", 1, 1.0), ("w", "r1", 2, 1.0), ("w", "r1", 3, 0.0)))
    heavy = Tree((("e", "r1", 0, 1.0), ("e", "r2", 1, 3.0), ("w", "r1", 2, 1.0), ("w", "r1", 3, 0.0)))
    docs = make_docs([(i, "x") for i in range(3000)])
    old, new = ({r.doc_id: r for r in shard(docs, t).collect()} for t in (light, heavy))
    assert all(r.grown_shard is None and r.shard != 3 for r in old.values())
    for i, r in old.items():
        if r.region == new[i].region == "w":
            assert r.shard == new[i].shard
        if r.region == "e":
            assert new[i].region == "e"


def test_empty(make_docs):
    assert shard(make_docs([]), Tree.even(4, 2, 2)).count() == 0
