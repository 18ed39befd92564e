from __future__ import annotations

import random

from ledgerloom.llm.components import components


def brute(links):
    part = {}

    def find(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            part[max(a, b)] = min(a, b)
    return {x: find(x) for x in part}


def test_chain_star_and_random(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 1000 + i) for i in range(300)]
    links += [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(120)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: c for x, c in brute(links).items() if any(x in p and p[0] != p[1] for p in links)}
    assert got == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
