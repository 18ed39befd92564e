from __future__ import annotations

import random
from collections import defaultdict

import pytest

from ledgerloom.llm import neardup
from ledgerloom.llm.shingles import MinHasher, overlap, shingle_set
from tests.llm.test_components import brute


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent=85):
    """Component of every distinct text, by comparing all pairs."""
    texts = defaultdict(list)
    for i, t in rows:
        if i is not None and shingles(t):
            texts[frozenset(shingles(t))].append(i)
    sets = [(min(ids), s) for s, ids in texts.items()]
    links = [
        (a, b)
        for k, (a, x) in enumerate(sets)
        for b, y in sets[:k]
        if 100 * len(x & y) >= percent * len(x | y)
    ]
    part = brute(links)
    return {s: part.get(node, node) for node, s in sets}


@pytest.fixture(scope="module")
def rows(prose):
    """Singles, copies, and three groups of near copies: close ones, chains and ones near the threshold."""
    rng = random.Random(1)
    out = [(i, " ".join(prose(60, i))) for i in range(60)]
    out += [(100 + i, out[3][1]) for i in range(40)] + [(140, out[4][1].upper())]
    for group, (size, edits) in enumerate([(60, 1), (60, 3), (60, 4)]):
        base = prose(150, 900 + group)
        for i in range(size):
            words = list(base)
            for _ in range(edits):
                words[rng.randrange(len(words))] = f"new{group}x{i}"
            out.append((1000 + 100 * group + i, " ".join(words)))
    step = prose(200, 77)
    for i in range(12):
        step = list(step)
        step[10 * i + 3] = f"chain{i}"
        out.append((2000 + i, " ".join(step)))
    out += [(3000, None), (3001, ""), (3002, " \n"), (None, out[3][1]), (None, out[0][1]), (3003, "one two"), (3004, "ONE two"), (3, out[3][1])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block,fan", [(1024, 256), (8, 4)])
def test_like_brute_force(make_docs, rows, monkeypatch, block, fan):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "FAN", fan)
    got = neardup.near_duplicates(make_docs(rows)).collect()
    assert len(got) == len(rows)
    want = expected(rows)
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        assert r.kept == (r.doc_id == r.component_id)
        if r.doc_id is not None:
            own = shingles(texts[r.doc_id][0])
            assert r.n_shingles == len(own)
            assert r.component_id == (want[frozenset(own)] if own else r.doc_id)
        else:
            assert r.component_id is None


def test_one_of_each_group_stays(make_docs, rows):
    docs = make_docs(rows)
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    parts = set(expected(rows).values())
    assert sorted(i for i in ids if i is not None and i not in (3000, 3001, 3002)) == sorted(parts)
    assert ids.count(None) == 2 and ids.count(3) == 1 and 3000 in ids


def test_a_repeated_id_with_two_texts(make_docs, prose):
    a, b = (" ".join(prose(40, s)) for s in (1, 2))
    got = neardup.near_duplicates(make_docs([(1, a), (2, a), (2, b), (3, b)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (2, 2), (3, 2)]


def test_two_classes_with_one_smallest_id(make_docs, prose):
    """Each text of id 1 has a near copy of its own, and the classes stay apart."""
    a, b = (" ".join(prose(200, s)) for s in (11, 12))
    rows = [(1, a), (1, b), (5, a + " more"), (6, b + " more"), (7, " ".join(prose(50, 13))), (1, None)]
    got = neardup.near_duplicates(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True)] * 3 + [(5, 1, False), (6, 1, False), (7, 7, True)]
    left = neardup.drop_near_duplicates(make_docs(rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in left) == sorted([(1, ""), (1, a), (1, b), (7, rows[4][1])])
    # Each text of id 3 is a copy of another document's: one component each, under its own smallest id.
    got = neardup.near_duplicates(make_docs([(3, a), (3, b), (2, a + " x"), (9, b + " x"), (9, a + " y z")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(2, 2, True), (3, 2, False), (3, 3, True), (9, 2, False), (9, 3, False)]


@pytest.mark.parametrize("name", ["found_id", "found_key", "node", "h1", "place", "start", "t_id"])
def test_columns_named_like_helpers(make_docs, prose, name):
    from pyspark.sql import functions as F

    text = " ".join(prose(40, 1))
    docs = make_docs([(1, text), (2, text), (2, text), (3, None)]).withColumn(name, F.lit(1))
    left = neardup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3]


def test_empty(make_docs):
    assert neardup.near_duplicates(make_docs([])).count() == 0
    assert neardup.drop_near_duplicates(make_docs([])).count() == 0


def test_minhashes_estimate_similarity(prose):
    a, b = prose(4000, 1), prose(4000, 1)
    b[:400] = prose(400, 2)
    x, y = shingle_set(" ".join(a), 5), shingle_set(" ".join(b), 5)
    true = overlap(x, y) / (len(x) + len(y) - overlap(x, y))
    hasher = MinHasher(2000)
    assert abs((hasher(x) == hasher(y)).mean() - true) < 0.04
