from __future__ import annotations

from collections import defaultdict

import pytest

from ledgerloom.llm import mixing
from ledgerloom.llm.queries import cycled_weights


def shares(sizes, weights, total, epochs):
    """Targets by clamping one source at a time."""
    target, open_ = {}, set(sizes)
    while open_:
        free = sum(weights[s] for s in open_)
        left = total - sum(target.values())
        over = [s for s in open_ if left * weights[s] / free > epochs * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / free for s in open_}
        for s in over:
            target[s] = epochs * sizes[s]
            open_.discard(s)
    return target


@pytest.fixture(scope="module")
def rows(prose):
    hot = [(i, " ".join(prose(5 + i % 40, i)), "a") for i in range(400)]
    rest = [(1000 + i, " ".join(prose(3 + i % 9, i)), "bcdef"[i % 5]) for i in range(200)]
    odd = [(None, "one two", None), (None, None, None), (2000, None, "g"), (2001, "", "g"), (5, "again here", "a"), (5, "again here", "a")]
    return hot + rest + odd


def test_targets_and_words_taken(make_docs, rows):
    docs = make_docs(rows)
    got = mixing.mix(docs, cycled_weights(docs), 1.5, 2.0).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    names = sorted((s for s in sizes if s), key=lambda s: s) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    want = shares(sizes, weights, 1.5 * sum(sizes.values()), 2.0)
    taken = defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source])
        assert r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert words == int(want[source] + 0.5)


def test_reruns_agree_and_seeds_differ(make_docs, rows):
    docs = make_docs(rows)

    def taken(frame, seed):
        return sorted(map(str, mixing.mix(frame, cycled_weights(frame), 1.5, 2.0, seed).select("doc_id", "taken").collect()))

    assert taken(docs, 1) == taken(docs.repartition(7, "text"), 1)
    assert taken(docs, 1) != taken(docs, 2)


def test_readings_are_whole_rows(make_docs, rows):
    docs = make_docs(rows)
    out = mixing.mixed_documents(docs, cycled_weights(docs), 1.5, 2.0)
    assert out.columns == docs.columns
    have = {(r.doc_id, r.text, r.source) for r in docs.collect()}
    assert {(r.doc_id, r.text, r.source) for r in out.collect()} <= have


def test_empty_and_share_above_all_caps(make_docs):
    empty = make_docs([])
    assert mixing.mix(empty, cycled_weights(empty), 1.5, 2.0).count() == 0
    docs = make_docs([(1, "a b c", "x"), (2, "a b", "y")])
    got = mixing.mix(docs, cycled_weights(docs), 9.0, 2.0).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(1, 6), (2, 4)}
