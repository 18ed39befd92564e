from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    library = Tokenizer.from_file(PATH)
    return lambda text: len(library.encode(text, add_special_tokens=False))


TEXTS = [
    "", " ", "a", "Plain words, then 12 numbers 3.5 and  two  spaces.", "line\nbreaks\r\n\t tabs   and　wide spaces", "it's we'll I'd 'quoted' don't",
    "x<|endoftext|>y and <|endoftext|> z<|endoftext|>", "żółć naïve 漢字かな 🙂🙂 é", "aaaa" * 5000, "word " * 30000, "1 2 3 a b c " * 9000 + " ", "!? " * 20000,
    "今天天气很好，我们去公园玩。" * 9000, "ก็ได้ครับ" * 9000, "QmFzZTY0IGlz1+/IGEx" * 8000, "a'll 'S x's!'s 3's'd" * 4000, "x <|endoftext|>y3" * 5000, "Много слов, да. " * 6000, "<|endof<|endoftext|>text|>" * 4000, "a \n\n  b\u00a0\x1c c\u2003d" * 4000,
]


@pytest.mark.parametrize("most", [7, 100, 64_000])
def test_pieces_count_like_the_whole(whole, most):
    assert tokens.lengths(TEXTS, PATH, most) == [whole(t) for t in TEXTS]
    for text in TEXTS:
        assert "".join(tokens.pieces(text, most)) == text


@pytest.mark.parametrize("text", [t for t in TEXTS if len(t) > 60_000])
def test_pieces_are_bounded_in_bytes(text):
    cut = list(tokens.pieces(text, 6_000))
    assert len(cut) > 5 and max(len(p.encode()) for p in cut) < 6_200


def test_random_mixtures(whole):
    rng = random.Random(5)
    parts = ["a", "Z", "é", "ß", "7", "٣", "½", " ", "  ", "\n", "\t", "\u3000", "'", "'s", "'ll", "!", "。", "—", "字", "ก", "็", "🙂", "<|endoftext|>", "<|", "|>", "\u200d", "\u0301"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(3000)]
    assert tokens.lengths(texts, PATH, 3) == [whole(t) for t in texts]


def test_rows(make_docs, whole):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "two words"), (99, None), (1, " ")]
    got = tokens.count_tokens(make_docs(rows), PATH, 1024).collect()
    want = [(i, len((t or "").encode()), whole(t or ""), whole(t or "") > 1024) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert tokens.count_tokens(make_docs([]), PATH, 1024).count() == 0


def test_piece_model(make_docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = tokens.count_tokens(make_docs([(1, "Some words here."), (2, None)]), path, 3).collect()
    assert {(r.doc_id, r.n_tokens) for r in got} == {(1, len(library.encode("Some words here."))), (2, 0)}
