from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from ledgerloom.llm.personal import FORMS, KINDS, base_spans, contexts, loose_spans, masked, personal_data
from ledgerloom.llm.queries import QUERIES
from tests.conftest import SF_DIR


def luhn(digits):
    rest = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(rest) % 10 == 0


def by_the_forms(text):
    """Base spans straight from the four expressions."""
    out = []
    for kind in KINDS:
        for m in re.finditer(FORMS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def said(text):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in base_spans(text))


def test_base_spans_like_the_forms():
    rng = random.Random(4)
    pieces = ["a@b.co", "@", "a.b", "x@y", ".", "..", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-2345", "+", "+1", "12 ", "-", " ", "é", "٣", "b@c.d.e@f.g", "9", "x9.8.7.6y", "++44.20.7946.0958", "(", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert said(text) == by_the_forms(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1 ", "1.", "+", "+1", "@", "a@", "a.", " at ", "a at b ", "(", "1:x "])
def test_very_long_runs_take_linear_time(unit):
    text = unit * (400_000 // len(unit))
    start = time.perf_counter()
    base_spans(text)
    list(loose_spans(text))
    assert time.perf_counter() - start < 5


def test_contexts():
    text = "Please call Me at +1 555 010 2345, or write."
    assert contexts(text, 18, 33) == ["at _", "me at _", "at _ ,"]
    assert contexts("x", 0, 1) == ["^ _", "^ ^ _", "^ _ $"]


@pytest.fixture(scope="module")
def rows(prose):
    """Contexts that stand beside one kind only, one that stands beside two kinds, and random ones."""
    rng = random.Random(9)
    out = []
    for i in range(40):
        words = prose(20, i)
        at = rng.randint(2, 17)
        mixed = f"number is {'+49 30 1234' + str(500 + i) if i % 2 else '10.0.3.' + str(i)}"
        out.append((i, " ".join([*words[:at], f"phone: +1 (212) 555-{1000 + i}", mixed, f"mail to user{i}@mail.example.org", *words[at:]])))
    out += [(50, "phone: 212-555-7777"), (51, "é phone: 555 0101 222 and mail to jo (at) mail (dot) example (dot) org now"), (52, "number is 212-555-7777"),
            (53, "ratio: 212-555-7777"), (54, "mail to jo at noon"), (55, "phone: 12"), (56, "phone: 99999999999999999999999"), (57, "mail to a@b")]
    out += [(60, None), (61, ""), (62, out[0][1]), (0, out[3][1]), (None, out[4][1]), (63, "x " * 100_000 + " phone: 212-555-8888")]
    # Copies do not make a pattern sure.
    out += [(100 + i, "secret line +1 (212) 555-0000 end") for i in range(30)] + [(200, "secret line 212-555-9999 end")]
    return out


def test_learned_contexts_find_unseen_identifiers(make_docs, rows):
    got = personal_data(make_docs(rows)).collect()
    assert len(got) == len(rows)
    text = dict(reversed(rows))
    found = {}
    for r in got:
        own = [t for i, t in rows if i == r.doc_id]
        wanted = {by_the_forms(t) for t in own}
        base = [t for t in wanted if hashlib.sha256(t.encode()).hexdigest() == r.base_sha256]
        assert base
        parts, more = [x for x in base[0].split(",") if x], r.spans.split(",") if r.spans else []
        assert set(parts) <= set(more) and len(more) == len(parts) + r.n_found
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x.startswith(k) for x in parts) for k in KINDS]
        assert more == sorted(more, key=lambda x: (KINDS.index(x.split(":")[0]), int(x.split(":")[1])))
        for x in [x for x in more if x not in parts]:
            kind, a, b = x.split(":")
            found.setdefault(r.doc_id, []).append((kind, text[r.doc_id][int(a):int(b)]))
    assert found == {
        50: [("phone", "212-555-7777")],
        51: [("email", "jo (at) mail (dot) example (dot) org"), ("phone", "555 0101 222")],
        57: [("email", "a@b")], 63: [("phone", "212-555-8888")],
    }


def test_masked(make_docs, rows):
    got = {r.doc_id: r for r in masked(make_docs(rows)).collect()}
    assert got[50].text == "phone: [phone]" and got[50].n_masked == 1
    assert got[60].text is None and got[61].text == "" and got[60].n_masked == 0
    assert "@" not in got[7].text and got[7].n_masked == 3


def test_empty(make_docs):
    assert personal_data(make_docs([])).count() == 0
    assert personal_data(make_docs([(1, None)])).collect()[0].base_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_over_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_personal"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.base_sha256 == hashlib.sha256(by_the_forms(docs[r.doc_id]).encode()).hexdigest()
