"""Quality rules: counts over words and lines, and bands of compression ratios."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import filtered, map_batches

#: Symbols that are counted (fixed by the query contract).
SYMBOLS = "#*$%&|<>"
_SYMBOLS = re.compile(rb"[#*$%&|<>]")
#: Limits of compressed / plain length by the length of a text in narrow bytes (``narrow``), from line
#: to line in its logarithm: prose compresses the better the longer it is.
LOW = ((256, 0.47), (512, 0.47), (1_024, 0.46), (2_048, 0.442), (4_096, 0.424), (8_192, 0.405), (16_384, 0.395), (32_768, 0.385), (65_536, 0.375), (131_072, 0.36))
HIGH = ((64, 1.5), (256, 0.95), (512, 0.85), (1_024, 0.78), (4_096, 0.70), (65_536, 0.65))
#: The same for chunks. Prose of 512 letters stays below 0.70, random letters and digits above 0.74.
CHUNK_LOW = ((256, 0.42), (512, 0.42), (1_024, 0.42), (4_096, 0.40))
CHUNK_HIGH = ((256, 0.80), (512, 0.73), (1_024, 0.68), (2_048, 0.65), (4_096, 0.63))
#: Bytes of a chunk: a sixteenth of the text, within these.
CHUNK_BYTES = 4_096
LEAST_CHUNK = 512
#: A text fails if chunks of more than this part of it are outside the band.
BAD_CHUNKS = 0.2
#: From this part of wide characters on a text has no upper limits, as in scripts of thousands of signs.
WIDE = 0.2

COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "whole_ratio double, n_chunks long, n_bad_chunks long, verdict string"
)


# Fixed layout of narrow bytes: the commonest other characters in one byte, the next in two.
_ONE, _TWO = 112, 15 * 256


def narrow(text: str) -> tuple[bytes, float]:
    """A text with its own characters renumbered, so that its script does not count, and the part of wide ones.

    ASCII stays. Of the other characters the commonest have one byte each, in whatever
    script, thousands more have two, any further one four: the same words in Latin, Cyrillic
    or Devanagari letters give bytes that differ in nothing but the letters' numbers.
    """
    if text.isascii():
        return text.encode(), 0.0
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found, at, n = np.unique(codes, return_inverse=True, return_counts=True)
    order = np.lexsort((found, -n, found < 128))
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    place = np.where(found < 128, -1, rank)[at]
    sizes = np.select([place < _ONE, place < _ONE + _TWO], [1, 2], 4)
    start = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    one, two, four = sizes == 1, sizes == 2, sizes == 4
    out[start[one]] = np.where(place < 0, codes, 128 + place)[one]
    rest = place[two] - _ONE
    out[start[two]], out[start[two] + 1] = 240 + rest // 256, rest % 256
    out[start[four]] = 255
    for k in range(3):
        out[start[four] + k + 1] = (codes[four] >> (8 * k)) & 255
    return out.tobytes(), float((sizes > 1).mean())


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    return zstandard.ZstdCompressor(level=3)


def limit(knots: tuple[tuple[int, float], ...], length: int) -> float:
    xs, ys = zip(*knots, strict=True)
    return float(np.interp(np.log(length), np.log(xs), ys))


def ratio(data: bytes) -> float:
    return len(_compressor().compress(data)) / len(data)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window whose words occur, in the same order, twice or more."""
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    code = ids[:n - window + 1].copy()
    for k in range(1, window):
        # Numbers of distinct windows so far, so that codes stay exact and small.
        code = np.unique(code * len(known) + ids[k:n - window + 1 + k], return_inverse=True)[1].astype(np.int64)
    hot = np.bincount(code)[code] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k:n - window + 1 + k] |= hot
    return int(covered.sum())


def repeated_lines(data: bytes) -> int:
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(text: str | None) -> tuple:
    """The counts and ratios of one text, and what the compression bands say of it."""
    data = (text or "").encode()
    words = data.split()
    chars = sum(len(w) for w in words) if data.isascii() else sum(len(w.decode()) for w in words)
    counts = (len(words), chars, len(_SYMBOLS.findall(data)), repeated_lines(data), repeated_words(words))
    if not data:
        return (*counts, None, 0, 0, "ok")
    data, wide = narrow(text)
    whole = ratio(data)
    size = max(LEAST_CHUNK, min(CHUNK_BYTES, len(data) // 16))
    # The last chunk takes what is left, so none is short.
    n = max(1, len(data) // size)
    cuts = [data[i * size:(i + 1) * size if i < n - 1 else len(data)] for i in range(n)] if n > 1 else []
    outside = [c for c in cuts if not limit(CHUNK_LOW, len(c)) <= ratio(c) <= (limit(CHUNK_HIGH, len(c)) if wide < WIDE else 9)]
    if whole < limit(LOW, len(data)):
        verdict = "repetitive"
    elif whole > limit(HIGH, len(data)) and wide < WIDE:
        verdict = "incompressible"
    else:
        verdict = "bad chunks" if sum(map(len, outside)) > BAD_CHUNKS * len(data) else "ok"
    return (*counts, whole, n, len(outside), verdict)


def accepted(measured: tuple) -> bool:
    """Whether a measured text passes the base rules and the compression bands."""
    n_words, n_repeat = measured[0], measured[4]
    return n_words >= 50 and 100 * n_repeat <= 50 * n_words and measured[8] == "ok"


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that ``quality`` keeps, with all their columns."""
    return filtered(docs, text_col, lambda texts: [accepted(measure(text)) for text in texts])


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ratios and a verdict for every row.

    Words are runs other than ASCII white space. ``base_failed`` marks fewer than
    50 words or over half of the words in repeated three-word windows. The verdict
    compares zstandard ratios of the whole text with the band of its length, and of
    its fixed chunks (from 1,024 letters on) with theirs: low is repetitive, high
    incompressible. Characters are renumbered first (``narrow``), so the bands hold for
    every script; texts of very many signs are only tested for repetition. A text is kept if
    it passes both. NULL counts as the empty text, which fails for its words; whole texts
    count, however long; rows that repeat an id are judged each. Other columns are
    not read, and ``keep_good`` keeps them as they are. An empty table gives an empty
    result. No shuffle: a row is judged alone.
    """

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(text) for text in part.column("text").to_pylist()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 9
        kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *arrays], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return map_batches(rows, judge, COLUMNS).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("verdict") == "ok")
    )
