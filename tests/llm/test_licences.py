from __future__ import annotations

import math
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import licences
from ledgerloom.llm.queries import QUERIES, SQL
from tests.compare import connect, difference, spark_rows, sql_rows
from tests.conftest import SF_DIR

MIT = dict(licences.TEMPLATES)["MIT"]


def words(text):
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def by_definition(rows, least):
    """(code, score, line) of each row, comparing every line and window with every template."""
    df = Counter(w for _, text, _ in rows for w in set(words(text or "")))
    longest = max(len(words(t)) for _, t in licences.TEMPLATES)

    def vector(text):
        return {w: n * (math.log((1 + len(rows)) / (1 + df[w])) + 1) for w, n in Counter(words(text)).items()}

    def cosine(a, b):
        norms = [math.sqrt(sum(x * x for x in v.values())) for v in (a, b)]
        return sum(x * b.get(w, 0) for w, x in a.items()) / norms[0] / norms[1]

    out = []
    for _, text, path in rows:
        lines, units = (text or "").split("\n"), []
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if not words(lines[j]) or (j > i and len(words(" ".join(lines[i:j]))) >= longest):
                    break
                units.append((j - i + 1, i, " ".join(lines[i:j + 1])))
        if re.match(licences.LICENCE_FILE.replace("(?i)", ""), (path or "").split("/")[-1], re.IGNORECASE):
            units.append((1, 0, text or ""))
        found = [
            (-round(score, 9), size, line, code) for size, line, unit in units if words(unit)
            for code, template in licences.TEMPLATES if (score := cosine(vector(unit), vector(template))) >= least
        ]
        best = min(found, default=None)
        out.append((best[3], -best[0], best[2]) if best else (None, None, None))
    return out


@pytest.fixture(scope="module")
def rows(prose):
    plain = " ".join(prose(40, 1))
    return [
        (1, plain, "a/b/c.txt"), (2, f"{plain}\nreleased under the mit license", "a/d.txt"), (3, MIT, "a/b/LICENSE"), (4, plain, "a/b/x/y.py"),
        (5, plain, "a/z.py"), (6, "All rights reserved.\n" + plain, "COPYING"), (7, plain, "q"), (8, None, "a/b/n"), (9, "", None), (None, plain, "a/b/c.txt"),
        (10, "Licensed under the Apache License, Version 2.0, by us all", "w/LICENSE.md"), (11, "Permission is hereby granted,\nfree of charge, to any person obtaining a copy of this software and associated\ndocumentation files, to deal in the software without restriction.", "v/licence"),
        (12, "the and of to this with", "w/k"), (13, "License", "w/j"), (4, plain, "a/b/x/y.py"),
    ]


def test_notices_by_definition(spark, rows):
    files = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, path string, code string")
    got = licences.notices(files).collect()
    want = sorted((str(i), p or "", *x) for (i, _, p), x in zip(rows, by_definition(rows, 0.6), strict=True))
    have = sorted((str(r.doc_id), r.path, r.code, r.score, r.line) for r in got)
    assert [h[:3] + h[4:] for h in have] == [w[:3] + w[4:] for w in want]
    assert [h[3] for h in have] == pytest.approx([w[3] for w in want], abs=1e-8)


def test_nearest_directory(spark, rows):
    files = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {(r.doc_id, r.path): (r.licence, r.inherited_from) for r in licences.scan(files).collect()}
    assert got[1, "a/b/c.txt"] == got[None, "a/b/c.txt"] == got[8, "a/b/n"] == ("MIT", "a/b")
    assert got[4, "a/b/x/y.py"] == ("MIT", "a/b")
    assert got[5, "a/z.py"] == got[7, "q"] == got[9, ""] == ("proprietary", "")
    assert got[2, "a/d.txt"] == ("MIT", None)
    assert got[12, "w/k"] == ("Apache-2.0", "w")
    assert licences.scan(files).count() == len(rows)
    assert licences.scan(files.limit(0)).count() == 0


def test_a_directory_takes_its_most_frequent_licence(spark):
    rows = [(i, text, f"d/{i}") for i, text in enumerate(["All rights reserved."] * 2 + ["Released under the MIT License."] * 2 + ["x"])]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string, path string"), declares=F.lit(True)).collect()
    assert {r.doc_id: r.licence for r in got}[4] == "MIT"


def test_strong_words_lose_nothing():
    vector = {"a": 0.1, "b": 0.2, "c": 0.5, "d": math.sqrt(1 - 0.3)}
    assert licences.strong_words(vector, 0.6) == {"d"}
    assert licences.strong_words(vector, 0.5) == {"c", "d"}


@pytest.mark.parametrize("width", [1, 4, 7])
@pytest.mark.parametrize("mark", ["", "# "])
def test_wrapped_headers(spark, prose, width, mark):
    plain = " ".join(prose(40, 1))
    rows = [(0, plain)]
    for k, (_, text) in enumerate(licences.TEMPLATES, 1):
        parts = text.split()
        header = [" ".join(parts[i:i + width]) for i in range(0, len(parts), width)]
        rows.append((k, "\n".join([plain, mark, *(mark + line for line in header), mark, plain])))
    files = spark.createDataFrame([(*r, "s/x.py") for r in rows], "doc_id long, text string, path string")
    got = {r.doc_id: (r.code, r.score, r.line) for r in licences.notices(files).collect()}
    assert got[0] == (None, None, None)
    assert [got[k] for k in range(1, len(rows))] == [(code, pytest.approx(1, abs=1e-6), 2) for code, _ in licences.TEMPLATES]


def test_the_size_of_the_table_does_not_decide(spark, prose):
    """A line with common words of the corpus scores the same among few and many like texts."""
    def score(n):
        rows = [(i, " ".join(["but was", *prose(12, i % 97)]) if i % 3 else " ".join(prose(14, i % 97)), "s/x") for i in range(n)]
        rows += [(-i, "released by us all\nlicensed", "s/y") for i in range(1, n // 50)]
        files = spark.createDataFrame([(10**6, "but was licensed under the mit license", "s/z"), *rows], "doc_id long, text string, path string")
        return licences.notices(files).filter("doc_id = 1000000").first()

    few, many = score(200), score(8000)
    assert few.code == many.code == "MIT" and abs(few.score - many.score) < 0.03


def test_a_very_long_list_of_notices(spark):
    """20,000 adjacent lines that all hold a notice."""
    text = "\n".join(f"part {i} is licensed under the mit license" for i in range(20_000))
    files = spark.createDataFrame([(1, text, "s/x"), (2, "nothing here", "s/y")], "doc_id long, text string, path string")
    start = time.perf_counter()
    got = {r.doc_id: r.code for r in licences.notices(files).collect()}
    assert got == {1: "MIT", 2: None} and time.perf_counter() - start < 90


def test_query_like_its_sql(spark):
    names, rows = spark_rows(QUERIES["op10_licences"](spark, SF_DIR))
    sql_names, want = sql_rows(connect(SF_DIR), SQL["op10_licences"])
    assert names == sql_names and rows == want, difference(rows, want)
