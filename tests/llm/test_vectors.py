from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import vectors
from ledgerloom.llm.vectors import Forest, near_vectors
from tests.llm.test_components import brute


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(i, rng.standard_normal(24).astype("f4").tolist()) for i in range(300)]
    hot = rng.standard_normal(24)
    out += [(400 + i, (hot + 0.1 * rng.standard_normal(24)).astype("f4").tolist()) for i in range(150)]
    out += [(600 + i, out[5][1]) for i in range(30)] + [(700, [2 * x for x in out[6][1]]), (5, out[5][1])]
    out += [(800, None), (801, [0.0] * 24), (802, [float("nan")] + [1.0] * 23), (803, [None] + [1.0] * 23), (804, [float("inf")] + [1.0] * 23), (None, out[5][1]), (805, out[5][1][:3]), (806, [])]
    return out


def expected(rows):
    good = [(k, i, np.asarray(v, "f8")) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = dict.fromkeys((k for k, _, _ in good), 0), []
    for n, (k, i, x) in enumerate(good):
        for m, j, y in good[:n]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links[k] += 1
                links[m] += 1
                pairs.append((i, j))
    part = brute(pairs)
    return sorted((str(i), links.get(k, 0), str(part.get(i, i))) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize(
    "forest", [Forest(), Forest(leaf_rows=40, block=16, spill=0.2, trees=10), Forest(fit_rows=24, leaf_rows=20, step=2, spill=0.15, trees=10)]
)
def test_like_brute_force(spark, rows, forest):
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, node long, copies long")
    got = near_vectors(table, params=forest).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == expected(rows)


def test_two_classes_with_one_smallest_id(spark):
    rng = np.random.default_rng(12)
    a, b = rng.standard_normal((2, 32))
    near = [(1, a), (1, b), (5, a + 0.01), (6, b + 0.01), (7, rng.standard_normal(32))]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in near], "vec_id long, embedding array<double>")
    got = near_vectors(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (1, 1, 1, True), (1, 1, 1, True), (5, 1, 1, False), (6, 1, 1, False), (7, 0, 7, True)
    ]


def test_empty(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(table).count() == 0


@pytest.mark.parametrize("forest", [Forest(), Forest(fit_rows=400, block=100)])
def test_all_links_of_a_large_group(spark, forest):
    rng = np.random.default_rng(1)
    size = 10_500 if forest == Forest() else 900
    hot = rng.standard_normal(64)
    v = np.concatenate([hot + 0.2 * rng.standard_normal((size, 64)), rng.standard_normal((2000, 64))]).astype("f4")
    unit = v.astype("f8") / np.linalg.norm(v.astype("f8"), axis=1, keepdims=True)
    want = [int(n) - 1 for at in range(0, len(v), 500) for n in (unit[at:at + 500] @ unit.T >= 0.95).sum(axis=1)]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in near_vectors(table, params=forest).collect()}
    assert [got[i] for i in range(len(v))] == want


def test_a_long_chain_is_one_component(spark):
    # Quarter turns from axis to axis in steps of 18 degrees: a row is linked with its two neighbours only.
    v = np.zeros((295, 60))
    for k in range(295):
        angle = k % 5 * np.pi / 10
        v[k, k // 5], v[k, k // 5 + 1] = np.cos(angle), np.sin(angle)
    ids = np.random.default_rng(3).permutation(295).tolist()
    rows = [(i, x.tolist()) for i, x in zip(ids, v, strict=True)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = near_vectors(table, params=Forest(leaf_rows=512, block=50)).collect()
    assert {r.component_id for r in got} == {0}
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == expected(rows)


def test_leaves_stay_small_beyond_the_sample(spark, monkeypatch):
    """Levels below those of the fitted sample keep leaves near ``leaf_rows`` and near copies together."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((3000, 64))
    twin = base + 0.2 * rng.standard_normal(base.shape)
    v = np.concatenate([base, twin]).astype("f4")
    unit = v.astype("f8") / np.linalg.norm(v.astype("f8"), axis=1, keepdims=True)
    close = np.flatnonzero((unit[:3000] * unit[3000:]).sum(axis=1) >= 0.95)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    sizes = {}
    for name, forest in {"one": Forest(fit_rows=200, leaf_rows=16), "many": Forest(fit_rows=20_000, leaf_rows=16)}.items():
        seen, by_group = [], vectors._by_group
        monkeypatch.setattr(vectors, "_by_group", lambda dealt, run, names: seen.append(dealt) or by_group(dealt, run, names))
        got = {r.vec_id: r.component_id for r in near_vectors(table, params=forest).collect()}
        monkeypatch.undo()
        sizes[name] = [r["count"] for r in seen[0].groupBy("leaf").count().collect()]
        found = sum(got[i] == got[i + 3000] for i in close.tolist())
        assert found >= 0.97 * len(close) > 0
    assert np.quantile(sizes["one"], 0.99) < 4 * np.quantile(sizes["many"], 0.99)
    assert max(sizes["one"]) < 300
