from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from ledgerloom.llm import quality


def written(n, seed):
    """``n`` words of many different letters."""
    rng = random.Random(seed)
    return ["".join(rng.choice("bcdfghjklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]


def repeated(words):
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)})


def test_repeated_words():
    rng = random.Random(2)
    for size in (0, 1, 2, 3, 4, 10, 60, 200):
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(size)]
        assert quality.repeated_words(words) == repeated(words)


def test_counts_by_hand():
    measured = quality.measure("A\u00f1\u00a0b#\t|c d\n\nx y\nx y\n \n")
    assert measured[:5] == (7, 12, 2, 1, 0)


def test_verdicts(make_docs):
    rng = random.Random(5)
    good = " ".join(written(400, 1))
    noise = " ".join("".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(60)) for _ in range(200))
    again = "".join(f"line {i % 5} says {i % 3} {i}\n" for i in range(400))
    rows = [(1, good), (2, noise), (3, again), (4, None), (5, ""), (6, "too few words"), (None, good), (1, good)]
    docs = make_docs(rows)
    got = quality.quality(docs).collect()
    assert sorted((str(r.doc_id), r.kept) for r in got) == sorted([("1", True), ("2", False), ("3", False), ("4", False), ("5", False), ("6", False), ("None", True), ("1", True)])
    assert {r.doc_id: r.verdict for r in got}[2] == "incompressible"
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs).count() == 3
    assert quality.quality(make_docs([])).count() == 0


def test_long_text_of_good_and_bad_chunks():
    words = written(30_000, 3)
    assert quality.measure(" ".join(words))[8] == "ok"
    rng = random.Random(1)
    noise = " ".join("".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(50)) for _ in range(3000))
    assert quality.measure(" ".join(words[:3000]) + " " + noise)[8] != "ok"


SCRIPTS = {"latin": 0, "accented": 0xE0, "cyrillic": 0x430, "devanagari": 0x905, "hangul": 0xAC00, "han": 0x4E00, "beyond": 0x1F600}


def in_script(text, first):
    """The same text with other letters."""
    return "".join(chr(first + ord(c) - 97) if first and "a" <= c <= "z" else c for c in text)


@pytest.mark.parametrize("size", [300, 2_000, 9_000, 40_000, 200_000])
@pytest.mark.parametrize("junk", [0.0, 0.3])
def test_verdict_does_not_depend_on_the_script(size, junk):
    rng = random.Random(size)
    words = written(size, 4)
    text = " ".join(words)[:size]
    text = text[:int(size * (1 - junk))] + "".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(int(size * junk)))
    again = "".join(f"{words[i % 5]} {words[i % 3]} " for i in range(size // 12))
    for plain in (text, again):
        found = {quality.measure(in_script(plain, first))[8] for first in SCRIPTS.values()}
        assert len(found) == 1
    if size >= 2_000:
        assert (quality.measure(text)[8] == "ok") == (not junk)


@pytest.mark.parametrize("size", [2_000, 7_000, 20_000, 60_000, 300_000])
@pytest.mark.parametrize("part", [0.3, 0.45])
def test_a_third_of_junk_fails(size, part):
    rng = random.Random(size)
    words = " ".join(written(size, 5))
    base64 = "".join(rng.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/") for _ in range(int(size * part)))
    assert quality.measure(words[:size])[8] == "ok"
    assert quality.measure(words[:int(size * (1 - part))] + " " + base64)[8] != "ok"
    assert quality.measure(base64 + " " + words[:int(size * (1 - part))])[8] != "ok"


def test_thousands_of_signs_are_no_junk():
    """Text of 3,000 signs with the frequencies of a language, and the same line again and again."""
    rng = random.Random(8)
    signs, weight = [chr(0x4E00 + i) for i in range(3000)], [1 / (i + 3) for i in range(3000)]
    text = "".join(rng.choices(signs, weight, k=6000))
    assert quality.measure(text)[8] == "ok"
    assert quality.measure(text[:60] * 100)[8] == "repetitive"


def test_narrow_keeps_characters_apart():
    rng = random.Random(3)
    text = "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x180), rng.randrange(0x4E00, 0x5E00), 0x1F600])) for _ in range(20_000))
    data, wide = quality.narrow(text)
    assert 0.2 < wide < 0.5 and len(data) < len(text.encode())
    assert quality.narrow("plain") == (b"plain", 0.0)
    # Equal pieces stay equal, different ones differ.
    for a, b in (("éè", "èé"), ("一", "丁")):
        both = quality.narrow(a + " " + b + " " + a)[0].split(b" ")
        assert both[0] == both[2] != both[1]


def test_counts_by_definition():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "\t", "#", "|", "é", "一", "ab "]) for _ in range(rng.randint(0, 40)))
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        duplicates = sum(x in lines[:i] for i, x in enumerate(lines))
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        assert quality.measure(text)[:5] == (len(words), sum(map(len, words)), symbols, duplicates, repeated(words))
