"""Personal data in texts: fixed forms, and contexts learned from them that find further identifiers."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import map_batches, python_workers, stored


@dataclass(frozen=True)
class Bootstrap:
    """How sure a pattern must be.

    A pattern is scored by its distinct instances: the sum of their scores over their
    number plus ``doubt``. It counts from ``seeds`` distinct base instances on, and
    finds new ones if its score is ``least`` or more after ``rounds`` rounds.
    """

    seeds: int = 8
    doubt: float = 1.0
    least: float = 0.8
    rounds: int = 3


# The kinds and their base forms.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A run of digits is entered at its begin only; the later places of a run match no more than it does.
_FORMS = {"ip": re.compile("(?<![0-9])" + FORMS["ip"]), "card": re.compile(FORMS["card"]), "phone": re.compile(FORMS["phone"])}
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Looser forms: an at sign, spelled out or not, between a name and a host, and groups of digits.
_AT = re.compile(r"@|\x20?[(\[]at[)\]]\x20?|\x20at\x20")
_LOOSE_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]+)*")
_DIGITS = re.compile(r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().:/-]{0,2}[0-9])+")
_NOT_DIGIT = re.compile(r"[^0-9]+")
#: Characters beside a place in which its words are looked for.
_AROUND = 80


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _holds(kind: str, text: str) -> bool:
    """Whether a match of the kind's form is one of the kind."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part) < 4 and int(part or 0) < 256 for part in (x.lstrip("0") for x in text.split(".")))
    digits = _NOT_DIGIT.sub("", text)
    return 13 <= len(digits) <= 19 and _luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the e-mail form, found from their at signs, as a long run without one would be tried from each place."""
    last, sign = 0, text.find("@")
    while sign >= 0:
        start = last + len(text[last:sign].rstrip(_LOCAL))
        host = _HOST.match(text, sign + 1) if start < sign else None
        if host:
            yield start, host.end()
        last = host.end() if host else sign + 1
        sign = text.find("@", last)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base forms, kind by kind and in order; kinds may overlap. Time is linear in the text."""
    out = [(0, a, b) for a, b in _addresses(text)]
    for k, kind in enumerate(KINDS[1:], 1):
        out += [(k, *m.span()) for m in _FORMS[kind].finditer(text) if _holds(kind, m.group())]
    return out


def loose_spans(text: str) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, kinds that it resembles) of what could be an identifier, base forms among them."""
    last = 0
    for m in _AT.finditer(text):
        start = last + len(text[last:m.start()].rstrip(_LOCAL)) if m.start() > last else m.start()
        host = _LOOSE_HOST.match(text, m.end())
        spelled = m.group() == " at "
        if start < m.start() and host and (not spelled or "." in host.group() or "dot" in host.group()):
            yield start, host.end(), [0]
        last = m.end()
    for m in _DIGITS.finditer(text):
        if not text[m.end():m.end() + 1].isalnum() and (kinds := _resembled(m.group())):
            yield *m.span(), kinds


def _resembled(text: str) -> list[int]:
    digits = len(_NOT_DIGIT.sub("", text))
    if digits > 19:
        return []
    groups = [g for g in _NOT_DIGIT.split(text) if g]
    out = [1] if len(groups) == 4 and all(len(g) < 4 and int(g) < 256 for g in groups) else []
    return out + ([2] if digits >= 12 else []) + ([3] if 7 <= digits <= 15 else [])


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: the word before, the two before, and the words on both sides."""
    before = text[max(0, start - _AROUND):start].lower().split()[-2:]
    after = text[end:end + _AROUND].lower().split()[:1]
    last, following = before[-1] if before else "^", after[0] if after else "$"
    return [f"{last} _", f"{' '.join(before) if len(before) > 1 else '^ ' + last} _", f"{last} _ {following}"]


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


_ROWS = (
    "row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, base_sha256 string, "
    "kind int, kinds array<int>, start int, finish int, instance long, pattern long, words string"
)


def _scanned(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (row, doc_id, text) one with its counts, and one for each pattern of every
    base span (with a kind) and every loose span that touches none (with the kinds it resembles).
    """
    columns = [c.split()[0] for c in _ROWS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [kinds[c.split()[1]] for c in _ROWS.split(", ")]

    def counted(row: int, doc_id: int | None, spans: list[tuple[int, int, int]]) -> tuple:
        said = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in range(len(KINDS))]
        return row, doc_id, *counts, said, hashlib.sha256(said.encode()).hexdigest(), None, None, None, None, None, None, None

    def places(row: int, text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple]:
        found = [(a, b, k, None) for k, a, b in spans]
        taken = sorted((a, b) for _, a, b in spans)
        starts = [a for a, _ in taken]
        furthest = list(accumulate((b for _, b in taken), max))
        for a, b, resembled in loose_spans(text):
            before = bisect_left(starts, b)
            if not before or furthest[before - 1] <= a:
                found.append((a, b, None, resembled))
        for a, b, kind, resembled in found:
            # What is one identifier in two spellings counts once.
            plain = text[a:b].lower() if kind == 0 or resembled == [0] else _NOT_DIGIT.sub(".", text[a:b])
            for c in contexts(text, a, b):
                yield row, *[None] * 7, kind, resembled, a, b, _key(plain), _key(c), c

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        by_column = list(zip(*rows, strict=True)) or [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(by_column, types, strict=True)], columns)

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for part in parts:
            for row, doc_id, text in zip(*(part.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                spans = base_spans(text) if text else []
                out.append(counted(row, doc_id, spans))
                for place in places(row, text, spans) if text else ():
                    out.append(place)
                    if len(out) >= 20_000:
                        yield batch(out)
                        out = []
        yield batch(out)

    python_workers(docs.sparkSession)
    return docs.select("row", "doc_id", "text").mapInArrow(scan, _ROWS)


def patterns(found: DataFrame, p: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, words, kind, seeds, score) of every pattern with enough base instances, scored on the graph.

    Edges join a pattern and the distinct instances seen with it. A pattern stands for
    the kind of which it has most base instances. Of its instances, base ones of that kind
    score 1, base ones of other kinds 0, and others start at 0. In each round
    a pattern gets the mean score of its instances (``doubt`` more count as 0), and every
    instance without a base form, for each kind it resembles, 1 - product(1 - score)
    over its patterns that score half or more: an instance that several good patterns
    hold lifts the rest of them. Each step joins edges and sums on the map side; the
    instances of a pattern are never gathered.
    """
    edges = stored(found.groupBy("pattern", "instance").agg(
        F.min("kind").alias("kind"), F.first("kinds", ignorenulls=True).alias("kinds"), F.min("words").alias("words")
    ))
    kinds = range(len(KINDS))
    size = edges.groupBy("pattern").agg(
        F.min("words").alias("words"), F.count(F.lit(1)).alias("instances"),
        *(F.count_if(F.col("kind") == k).alias(f"seeds_{k}") for k in kinds),
    )
    most = F.greatest(*(F.struct(F.col(f"seeds_{k}").alias("seeds"), F.lit(-k).alias("order")) for k in kinds))
    known = stored(size.select("pattern", "words", "instances", most.alias("most")).select(
        "pattern", "words", "instances", F.col("most.seeds").alias("seeds"), (-F.col("most.order")).alias("kind")
    ).filter(F.col("seeds") >= p.seeds))
    # Only these edges can change a score: of a pattern with seeds, to an instance that resembles its kind.
    loose = edges.filter("kind is null").select("pattern", "instance", "kinds").join(known.select("pattern", "kind"), "pattern")
    loose = stored(loose.filter(F.array_contains("kinds", F.col("kind"))).select("pattern", "instance", "kind"))
    score = stored(known.select("pattern", (F.col("seeds") / (F.col("instances") + p.doubt)).alias("score")))
    for _ in range(p.rounds - 1):
        # ``doubt`` keeps every score below 1.
        likely = loose.join(score, "pattern").filter("score >= 0.5").groupBy("instance", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("held")
        )
        more = loose.join(likely, ["instance", "kind"]).groupBy("pattern").agg(F.sum("held").alias("more"))
        score = stored(known.join(more, "pattern", "left").select(
            "pattern", ((F.col("seeds") + F.coalesce("more", F.lit(0.0))) / (F.col("instances") + p.doubt)).alias("score")
        ))
    return known.join(score, "pattern").select("pattern", "words", "kind", "seeds", "score")


def personal_data(
    docs: DataFrame, params: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_found of every row.

    The four counts and the digest are of the base forms (``FORMS``, with the checks of
    ``_holds``), which always stay. Base instances are the seeds of patterns, the words beside
    them; patterns that stand nearly always beside one kind (``patterns``) then mark what else
    stands in their place and resembles the kind: an address with its at sign
    spelled out, a card number with a slip, a number without its country. ``n_found`` counts
    these. ``spans`` lists all, kind:start:end by kind and start, in code points, the end
    exclusive.

    A place that several kinds claim goes to the pattern with the highest score, then to
    the first kind. NULL and empty texts have no spans. Rows that repeat an id are scanned
    each, and whole texts however long, in linear time; equal instances count once for a
    pattern, so copies do not make it sure. Other columns are not read. An empty table gives
    an empty result.
    """
    p = params
    scanned = stored(_scanned(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )))
    found = scanned.filter("pattern is not null")
    base = scanned.filter("pattern is null")
    sure = patterns(found, p).filter(F.col("score") >= p.least).select("pattern", F.col("kind").alias("sure_kind"), "score")
    new = found.filter("kind is null").join(sure, "pattern").filter(F.array_contains("kinds", F.col("sure_kind")))
    new = new.groupBy("row", "start", "finish").agg(F.max(F.struct("score", (-F.col("sure_kind")).alias("order"))).alias("best"))
    listed = new.select("row", F.struct((-F.col("best.order")).alias("kind"), "start", "finish").alias("span")).groupBy("row").agg(
        F.collect_list("span").alias("more")
    )
    return base.join(listed, "row", "left").select(
        "doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", _joined(F.col("base_spans"), F.col("more")).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_found"),
    )


def _joined(base: Column, more: Column) -> Column:
    """Base spans as text with further ones, by kind and start."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    parts = F.filter(F.split(base, ","), lambda s: s != "")
    own = F.transform(parts, lambda s: F.struct(
        (F.array_position(names, F.split_part(s, F.lit(":"), F.lit(1))) - 1).cast("int").alias("kind"),
        F.split_part(s, F.lit(":"), F.lit(2)).cast("int").alias("start"), F.split_part(s, F.lit(":"), F.lit(3)).cast("int").alias("finish"),
    ))
    every = F.array_sort(F.concat(own, more))
    said = F.transform(every, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["finish"].cast("string")))
    return F.when(more.isNull(), base).otherwise(F.array_join(said, ","))


def masked(docs: DataFrame, params: Bootstrap = Bootstrap(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text with every span replaced by its kind in brackets, and n_masked.

    Spans that overlap are replaced together, under the kind of the first. A NULL text stays NULL.
    """
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(kept).withColumn("m_row", F.monotonically_increasing_id())
    spans = personal_data(rows.select(F.col("m_row").alias("doc_id"), "text"), params).select(F.col("doc_id").alias("s_row"), "spans")

    def mask(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts = [], []
        for text, said in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
            spans = sorted((int(a), int(b), kind) for kind, a, b in (s.split(":") for s in said.split(",") if s))
            out, at, n = [], 0, 0
            for a, b, kind in spans:
                if a >= at:
                    out += [text[at:a], f"[{kind}]"]
                    n += 1
                at = max(at, b)
            texts.append(text and "".join(out) + text[at:])
            counts.append(n)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["doc_id", "text", "n_masked"])

    joined = rows.join(spans, F.col("m_row") == F.col("s_row")).select("doc_id", "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(joined, mask, f"doc_id {kind}, text string, n_masked long")
