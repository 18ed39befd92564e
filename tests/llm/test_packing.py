from __future__ import annotations

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import packing


def padding(bounds, lengths, counts):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(60), 9))
    counts = [rng.randint(1, 30) for _ in lengths]
    for k in (1, 2, 3, 9, 12):
        got = packing.best_boundaries(np.array(lengths), np.array(counts), k)
        best = min(padding([*c, lengths[-1]], lengths, counts) for n in range(min(k, 9)) for c in itertools.combinations(lengths[:-1], n))
        assert len(got) <= k and padding(got, lengths, counts) == best


def test_batches(make_docs, prose):
    rng = random.Random(8)
    rows = [(i, " ".join(prose(rng.choice([1, 5, 30, 31, 200]), i))) for i in range(500)] + [(None, None), (7, ""), (7, ""), (600, "w " * 5000)]
    got = packing.pack(make_docs(rows), budget=400, buckets=4).collect()
    assert len(got) == len(rows)
    batches = defaultdict(list)
    for r in got:
        assert r.padded == r.n_tokens + r.padding and r.padding >= 0
        batches[r.bucket, r.batch].append(r)
    last = {b: max(k for c, k in batches if c == b) for b, _ in batches}
    for (bucket, batch), own in batches.items():
        room = max(1, 400 // max(1, own[0].padded))
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert len(own) == room if batch < last[bucket] else len(own) <= room
    assert packing.pack(make_docs([]), 400, 4).count() == 0


def test_long_lengths_share_bins(spark):
    rows = spark.range(200_000).selectExpr("id + 1 as n_tokens")
    lengths, counts = packing.histogram(rows)
    assert len(lengths) < 6000 and counts.sum() == 200_000 and (np.diff(lengths) > 0).all() and lengths[-1] == 200_000


@pytest.mark.parametrize("seed", range(3))
def test_padded_size_above_the_exact_lengths(spark, seed):
    rng = np.random.default_rng(seed)
    drawn = np.concatenate([rng.integers(1, 1025, 1500), (rng.pareto(1.1, 1500) * 1500 + 1025).astype(int).clip(0, 400_000)])
    lengths, counts = np.unique(drawn, return_counts=True)
    binned = packing.histogram(spark.createDataFrame([(int(x),) for x in drawn], "n_tokens long"))
    assert len(binned[0]) < len(lengths)
    for buckets in (2, 8, 16):
        total = int((lengths * counts).sum())
        best = total + padding(packing.best_boundaries(lengths, counts, buckets), lengths, counts)
        got = total + padding(packing.best_boundaries(*binned, buckets), lengths, counts)
        assert best <= got <= best * (1 + 2 / packing.EXACT)


def test_lengths_in_tokens(make_docs, prose):
    import public_tokenizers

    from ledgerloom.llm.tokens import count_tokens

    docs = make_docs([(i, " ".join(prose(40 + i, i))) for i in range(50)] + [(99, None)])
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), 1024).withColumn("text", F.lit("one"))
    got = packing.pack(counted, budget=500, buckets=4, length=F.col("n_tokens")).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted((r.doc_id, r.n_tokens) for r in counted.collect())
