from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, component long, size long, row string, kept boolean"
_SYLLABLES = ["ka", "ro", "mi", "ten", "sol", "ba", "lu", "per", "dan", "vi", "gos", "ne"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns named like the operators' own."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), -1, "x", -2, -3, "y", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """``n`` made-up words from a seed."""

    def build(n: int, seed: int) -> list[str]:
        rng = random.Random(seed)
        return ["".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]

    return build
