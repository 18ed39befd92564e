"""Count the tokens of texts with a given tokenizer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import map_batches

#: Bytes of a piece of a long text, and of the pieces encoded at once.
PIECE_BYTES = 64_000
BATCH_BYTES = 1_000_000
#: Byte-level BPE cuts a text into words first, by classes of characters: letters, digits and
#: other signs, each with at most one space before them. It never merges over the place before
#: white space that follows something else, nor where one class ends and another begins
#: (but for the apostrophe, which may belong to the letters after it). The classes hold
#: characters that every version of Unicode puts there: ASCII, kana, Chinese, Cyrillic,
#: Greek, and Thai, whose vowel signs above and below count as other signs.
_LETTER = "A-Za-zА-яΑ-Ρα-ωぁ-ゖァ-ヺ一-龥\u0e01-\u0e30\u0e32\u0e33\u0e40-\u0e46"
_OTHER = "!-&(-/:-@[-`{-~、。「」！，：；？\u0e31\u0e34-\u0e3a\u0e47-\u0e4e"
_SAFE = re.compile(
    rf"(?<=\S)(?=[ \t\r\n])|(?<=[{_LETTER}])(?=[0-9{_OTHER}])|(?<=[0-9])(?=[{_LETTER}{_OTHER}])|(?<=[{_OTHER}])(?=[0-9{_LETTER}])"
)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


def _splits(path: str) -> tuple[str, ...] | None:
    """The texts of added tokens if texts may be split: byte-level BPE whose words start with their space."""
    if path.endswith(".model"):
        return None
    import json

    step = json.loads(_tokenizer(path).to_str())
    first, added = step.get("pre_tokenizer") or {}, step.get("added_tokens") or []
    fits = step.get("normalizer") is None and first.get("type") == "ByteLevel" and bool(first.get("use_regex", True))
    # Tokens that take in what stands beside them have no bound to look for them.
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    return tuple(t["content"] for t in added) if fits and plain and not first.get("add_prefix_space") else None


def _bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))


def pieces(text: str, most: int = PIECE_BYTES, added: tuple[str, ...] = ()) -> Iterator[str]:
    """Cut a text at safe places outside ``added`` tokens into pieces of ``most`` bytes or little more.

    A piece is longer only where no safe place is near, as in one word of that length.
    """
    around = max((len(t) for t in added), default=1) - 1
    start = 0
    while len(text) - start > most // 4:
        part = text[start:start + most]
        if not part.isascii():
            part = part.encode("utf-8", "surrogatepass")[:most].decode("utf-8", "ignore")
        if start + len(part) >= len(text):
            break
        at = start + max(1, len(part))
        for cut in _SAFE.finditer(text, at):
            beside = text[max(0, cut.start() - around):cut.start() + around]
            if not any(t in beside for t in added):
                break
        else:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def lengths(texts: list[str], path: str, most: int = PIECE_BYTES) -> list[int]:
    """The number of tokens of each text, encoded in batches of about ``BATCH_BYTES``."""
    counts = [0] * len(texts)
    tokenizer = _tokenizer(path)
    added = _splits_cached(path)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if path.endswith(".model"):
            found = [len(ids) for ids in tokenizer.encode(batch, num_threads=1)]
        else:
            found = [len(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        for owner, n in zip(owners, found, strict=True):
            counts[owner] += n
        batch.clear()
        owners.clear()
        held = 0

    for i, text in enumerate(texts):
        for piece in (text,) if added is None else pieces(text, most, added):
            batch.append(piece)
            owners.append(i)
            held += _bytes(piece)
            if held >= BATCH_BYTES:
                flush()
    if batch:
        flush()
    return counts


_splits_cached = lru_cache(maxsize=4)(_splits)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row.

    The whole text counts, without added special tokens; the name of a special
    token inside a text is read as the library reads it. NULL counts as the empty
    text: no tokens. Rows that repeat an id are counted each.

    Other columns, whatever their names, are not read. An empty table gives an empty
    result.

    ``tokenizer_path`` is a file that every executor has. Long texts are cut at
    places where the count is the same as for the whole, so the memory for a batch
    is bounded by bytes; there is no shuffle. A tokenizer other than byte-level BPE,
    or one word of any length, is encoded whole.
    """

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        found = lengths(part.column("text").to_pylist(), tokenizer_path)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("n_bytes"), pa.array(found, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"],
        )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    counted = map_batches(rows, count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
