from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import negatives
from ledgerloom.llm.negatives import Mining, Tree, Wanted, best_first, fit, hard_negatives, packed
from ledgerloom.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, spark_rows, sql_rows
from tests.conftest import SF_DIR

SMALL = Mining(tree_rows=40, leaf_rows=4, fanout=3, fit_rows=200, anchor_rows=7)


@pytest.fixture(scope="module")
def rows():
    """Random and clustered vectors, copies (hot ones too), ties, untidy rows."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((6, 12))
    out = [(i, (centres[i % 6] + 0.5 * rng.standard_normal(12)).astype("f4").tolist(), int(rng.integers(0, 5))) for i in range(420)]
    out += [(1000 + i, out[3][1], i % 3) for i in range(120)] + [(2000 + i, [round(4 * x) / 4 for x in out[i][1]], i % 2) for i in range(60)]
    out += [(100, out[100][1], out[100][2]), (50, out[9][1], 3), (350, [-x for x in out[3][1]], 1)]
    out += [(450, None, 1), (500, [None] + [1.0] * 11, 1), (550, [float("nan")] + [1.0] * 11, 1), (600, [float("inf")] + [1.0] * 11, 1), (650, out[1][1], None)]
    out += [(None, out[2][1], 1), (700, out[2][1][:5], 1), (701, out[3][1][:5], 1), (702, out[4][1][:5], 2), (750, [], 1), (751, [], 1), (752, [], 2), (800, [0.0] * 12, 2), (-50, out[5][1], 9)]
    return out


def expected(rows, relabel=lambda i, label: label, size=256):
    good = [(k, i, relabel(i, c), [math.floor(size * float(np.float32(x))) for x in v]) for k, (i, v, c) in enumerate(rows)
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for k, i, c, a in good:
        if i % 50:
            continue
        scores = sorted((-sum(map(int.__mul__, a, b)), j, m, c == d) for m, j, d, b in good if m != k and len(a) == len(b))
        for s, j, _, _ in [x for x in scores if x[3]][:5]:
            fit_ = [x for x in scores if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out.update((i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit_))
    return out


@pytest.mark.parametrize("params", [Mining(), SMALL])
def test_like_brute_force(spark, rows, params):
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, key long, tile long, rank int")
    got = hard_negatives(table, params=params)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    want = expected(rows)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 50


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (2.0**20 * rng.standard_normal(3)).astype("f4").tolist(), i % 2) for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = Counter(map(tuple, hard_negatives(table, params=SMALL).collect()))
    assert got == expected(rows) and max(r[4] for r in got) > 1 << 53


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(table).count() == 0


def test_leaves_left_out_are_not_needed():
    rng = np.random.default_rng(5)
    rows = np.floor(256 * (rng.standard_normal((40, 8))[rng.integers(0, 40, 4000)] + 0.05 * rng.standard_normal((4000, 8))))
    labels = rng.integers(0, 3, 4000)
    order = packed(np.concatenate([labels[:, None], rows], axis=1), 16)
    assert sorted(order.tolist()) == list(range(4000))
    tree = Tree(order, order, labels[order], rows[order], Mining(leaf_rows=16))
    low, high = tree.intervals(rows[:20])
    read = 0
    for a in range(20):
        scores = rows @ rows[a]
        inside = [scores[order[16 * n:16 * n + 16]] for n in range(tree.leaves)]
        assert all(low[a, n] <= s.min() and s.max() <= high[a, n] for n, s in enumerate(inside))
        assert low[a, -1] <= scores.min() and scores.max() <= high[a, -1]
        want = Wanted(a, int(labels[a]), True, 5, np.array([-np.inf]), np.array([np.inf]))
        read += best_first(tree, rows[a], want, low[a], high[a])
        best = sorted((-s, i, i) for i, s in enumerate(scores) if labels[i] == labels[a] and i != a)[:5]
        assert want.found[0] == best
    assert read < 20 * tree.leaves / 4


def test_tiles_are_even_with_hot_vectors():
    rng = np.random.default_rng(6)
    keys = np.concatenate([np.zeros((3000, 1)), np.floor(256 * rng.standard_normal((3000, 4)))], axis=1)
    keys[:1200, 1:] = keys[0, 1:]
    spread = negatives._spread(np.arange(3000))
    cuts = fit(keys[::2], spread[::2], 16)
    sizes = np.bincount(cuts.tile(keys, spread))
    assert len(sizes) >= 8 and sizes.max() < 3 * sizes.mean()


def test_query_like_its_sql(spark):
    names, rows = spark_rows(QUERIES["op11_negatives"](spark, SF_DIR))
    sql_names, want = sql_rows(connect(SF_DIR), SQL["op11_negatives"])
    assert names == sql_names and rows == want, difference(rows, want)
    assert sum(rows.values()) > 100
