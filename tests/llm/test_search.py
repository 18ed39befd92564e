from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm.queries import QUERIES, SQL
from ledgerloom.llm.search import Search, Segment, impacts, search, search_segment, terms
from tests.compare import connect, difference, spark_rows, sql_rows
from tests.conftest import SF_DIR

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, top=10):
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 25 + 75 * sum(c.values()) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in split(text) if c[t]
            )
            if score:
                found.append((-score, i is None, i))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda x: (*x[:2], x[2] or 0))[:top])]
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def rows(prose):
    """Texts of a shared vocabulary, a very common word in each, groups of equal and near texts, one very long text."""
    rng = random.Random(3)
    docs = [(i, " ".join(["The", *prose(rng.randint(1, 60), i % 90)])) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [(2000 + i, docs[8][1] + f" x{i}") for i in range(40)]
    docs += [(3000, None), (3001, ""), (3002, "-- \n"), (None, docs[7][1]), (7, docs[7][1]), (3003, "naïve ÀÉ ka_ro ΣΑΣ 日本語"), (3004, " ".join(prose(30_000, 5)))]
    rng.shuffle(docs)
    items = [(k, " ".join(docs[3 * k][1].split()[:12]) if docs[3 * k][1] else None) for k in range(40)]
    items += [(100, None), (101, ""), (102, "the the the"), (103, "no such words"), (3, docs[7][1]), (104, "NAÏVE àé ΣΑΣ 日本語 ka"), (None, "karo milu")]
    return docs, items


@pytest.mark.parametrize("params", [Search(), Search(segment_rows=50, block_rows=4, first_rows=100), Search(segment_rows=70, block_rows=2, item_terms=100, first_rows=0, segment_entries=900)])
def test_like_brute_force(spark, make_docs, rows, params):
    docs, items = rows
    table = spark.createDataFrame([(i, t, 7, 1) for i, t in items], "item_id long, text string, item long, rank int")
    got = search(make_docs(docs), table, params).collect()
    assert sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in got) == expected(docs, items)


def test_terms():
    text = "Ab-cD, É1ñ_x\tÄÖ 9.5 İK"
    assert [t.decode() for t in terms(text)] == split(text)
    assert terms(None) == terms("") == []


def test_blocks_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(1)
    p = Search(block_rows=8)
    # Groups of documents that share terms, so similar documents lie in one block.
    group = rng.integers(0, 20, 2000)
    sets = [np.unique(np.concatenate([[0], 1 + 10 * g + rng.integers(0, 10, 6)])) for g in group]
    sizes = np.array([len(x) for x in sets])
    counts = rng.integers(1, 5, sizes.sum())
    segment = Segment(list(range(2000)), sizes, np.concatenate(sets), impacts(counts, np.full(sizes.sum(), 50), 2000, 100_000), 201, p)
    weight = np.zeros(201, np.int64)
    own = np.array([0, 31, 33, 35, 37])
    weight[own] = [900, 3000, 2500, 2800, 2000]
    every = segment.scores(np.arange(2000), weight)
    cut = segment.list(0)
    assert sorted(cut.docs.tolist()) == list(range(2000))
    for k, bound in enumerate(cut.bounds(weight)):
        assert every[cut.docs[cut.starts[k]:cut.starts[k + 1]]].max() <= bound
    scored = []
    segment.scores, inner = lambda docs, w: scored.extend(docs) or inner(docs, w), segment.scores
    best = search_segment(segment, own, weight, 1, [], 10)
    assert best == sorted(((int(s), i) for i, s in enumerate(every)), key=lambda x: (-x[0], x[1]))[:10]
    assert len(scored) < 600


def test_empty(spark, make_docs):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(make_docs([]), items).count() == 0
    assert search(make_docs([(1, None)]), items).count() == 0
    assert search(make_docs([(1, "a b")]), items.limit(0)).count() == 0


def test_query_like_its_sql(spark):
    names, rows = spark_rows(QUERIES["op13_search"](spark, SF_DIR))
    sql_names, want = sql_rows(connect(SF_DIR), SQL["op13_search"])
    assert names == sql_names and rows == want, difference(rows, want)
