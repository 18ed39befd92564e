"""Ranked lexical search over posting lists cut into geometric blocks with exact summary bounds."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F

from ledgerloom.llm.common import map_batches, python_workers, stored


@dataclass(frozen=True)
class Search:
    """How the index is cut and how much is searched at once.

    A segment is at most ``segment_rows`` documents, or ``segment_entries`` of their
    terms, of one input partition; it has posting lists of its own. A list is cut into
    blocks of about ``block_rows`` documents that are alike. Items are searched in
    groups with about ``item_terms`` terms, so what a task holds of them is bounded. At most
    ``first_rows`` documents are searched ahead, for a score that the others must reach.
    """

    top: int = 10
    segment_rows: int = 4_096
    segment_entries: int = 4_000_000
    block_rows: int = 64
    item_terms: int = 50_000
    first_rows: int = 16_384
    #: Random directions on which documents are compared when a list is cut.
    directions: int = 32
    seed: int = 41


#: ASCII letters and digits and all bytes of other characters stay, A-Z become a-z, the rest separates.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order: maximal runs of ASCII letters, digits and other than ASCII characters; only A-Z lower-cased."""
    return text.encode().translate(_BYTES).split() if text else []


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What an occurrence count is worth in a document of n terms, without the weight of its term."""
    tf, m = tf.astype(np.int64), 25 + (75 * n.astype(np.int64) * docs) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


@dataclass(frozen=True)
class Items:
    """A group of items: distinct terms by number, and for each item its terms with their weights times repeats."""

    numbers: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


class _List:
    """A posting list in blocks: documents block by block, and each block's largest impact of every term."""

    def __init__(self, docs: np.ndarray, starts: np.ndarray, ids: np.ndarray, most: np.ndarray, ends: np.ndarray):
        self.docs, self.starts, self.ids, self.most, self.ends = docs, starts, ids, most, ends

    def bounds(self, weight: np.ndarray) -> np.ndarray:
        """The most that a document of each block can score."""
        return np.add.reduceat(weight[self.ids] * self.most, self.ends)


class Segment:
    """Documents with the impacts of their terms, and the posting lists over them, cut when first asked for."""

    def __init__(self, ids: list, sizes: np.ndarray, terms_: np.ndarray, impact: np.ndarray, vocabulary: int, p: Search):
        self.ids, self.terms, self.impact, self.p, self.vocabulary = ids, terms_, impact, p, vocabulary
        self.ptr = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(terms_, kind="stable")
        self.owner = np.repeat(np.arange(len(ids)), sizes)[order]
        self.list_ptr = np.searchsorted(terms_[order], np.arange(vocabulary + 1))
        self.most = np.zeros(vocabulary, np.int64)
        np.maximum.at(self.most, terms_, impact)
        self.lists: dict[int, _List] = {}
        self.held = 0
        signs = np.random.default_rng(p.seed).choice(np.array([-1, 1], np.float32), (vocabulary, p.directions))
        filled = np.flatnonzero(sizes)
        self.place = np.zeros((len(ids), p.directions), np.float32)
        if len(filled):
            self.place[filled] = np.add.reduceat(signs[terms_] * impact[:, None].astype(np.float32), self.ptr[filled])
        self.place /= np.maximum(np.linalg.norm(self.place, axis=1, keepdims=True), 1e-9)

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all terms of the documents, and where each document's begin."""
        sizes = self.ptr[docs + 1] - self.ptr[docs]
        begin = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.ptr[docs] - begin, sizes), begin

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        at, begin = self._entries(docs)
        return np.add.reduceat(weight[self.terms[at]] * self.impact[at], begin)

    def list(self, term: int) -> _List:
        """The list of a term, remembered while all lists together are not larger than a segment may be."""
        if term not in self.lists:
            if self.held > self.p.segment_entries:
                self.lists, self.held = {}, 0
            made = self.lists[term] = self._cut(self.owner[self.list_ptr[term]:self.list_ptr[term + 1]], term)
            self.held += len(made.ids)
        return self.lists[term]

    def _cut(self, docs: np.ndarray, term: int) -> _List:
        """Deal a list to the most similar of as many of its documents as it has blocks."""
        size = self.p.block_rows
        blocks = -(-len(docs) // size)
        if blocks > 1:
            chosen = np.random.default_rng((self.p.seed, term)).choice(docs, blocks, replace=False)
            nearest = (self.place[docs] @ self.place[chosen].T).argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            docs, nearest = docs[order], nearest[order]
            first = np.flatnonzero(np.diff(nearest, prepend=-1))
            # A block that drew very many is cut again, so one summary never stands for most of a list.
            place = np.arange(len(docs)) - np.repeat(first, np.diff(np.append(first, len(docs))))
            starts = np.flatnonzero(place % (4 * size) == 0)
        else:
            starts = np.zeros(1, np.int64)
        return _List(docs, np.append(starts, len(docs)), *self._summaries(docs, starts))

    def _summaries(self, docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, _ = self._entries(docs)
        sizes = self.ptr[docs + 1] - self.ptr[docs]
        block = np.repeat(np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(docs)))), sizes)
        key, impact = block * self.vocabulary + self.terms[at], self.impact[at]
        if len(starts) * self.vocabulary <= 8 * len(key):
            dense = np.zeros(len(starts) * self.vocabulary, np.int64)
            np.maximum.at(dense, key, impact)
            keys = np.flatnonzero(dense)
            most = dense[keys]
        else:
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            keys, most = key[order][first], np.maximum.reduceat(impact[order], first)
        return keys % self.vocabulary, most, np.searchsorted(keys, np.arange(len(starts)) * self.vocabulary)


def _best(found: list[tuple], top: int) -> list[tuple]:
    """The ``top`` first of (score, doc_id): higher scores first, then smaller ids, NULL last."""
    return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:top]


def search_segment(s: Segment, own: np.ndarray, weight: np.ndarray, least: int, best: list[tuple], top: int) -> list[tuple]:
    """``best`` with the documents of a segment that belong to the ``top`` and score ``least`` at least.

    ``own`` are the item's terms, ``weight`` the weights of all terms (0 where not of the item).
    Terms whose largest impacts together stay below the score to reach need no list: a
    document without any other term cannot reach it. Of the other lists, blocks are
    taken by falling bounds, and those with a bound below the score to reach are skipped.
    """
    own = own[s.most[own] > 0]
    reach = max(least, best[-1][0] if len(best) == top else 1)
    most = weight[own] * s.most[own]
    order = np.argsort(most, kind="stable")
    needed = own[order][np.cumsum(most[order]) >= reach]
    if not len(needed):
        return best
    lists = [s.list(int(t)) for t in needed]
    bounds = np.concatenate([x.bounds(weight) for x in lists])
    of = np.repeat(np.arange(len(lists)), [len(x.starts) - 1 for x in lists])
    within = np.concatenate([np.arange(len(x.starts) - 1) for x in lists])
    order = np.argsort(-bounds, kind="stable")
    bounds, of, within = bounds[order], of[order], within[order]
    seen = np.zeros(len(s.ids), bool)
    at, step = 0, 4
    while at < len(bounds) and bounds[at] >= reach:
        end = min(at + step, int(np.searchsorted(-bounds, -reach, side="right")))
        docs = np.concatenate([lists[i].docs[lists[i].starts[k]:lists[i].starts[k + 1]] for i, k in zip(of[at:end], within[at:end], strict=True)])
        docs = np.unique(docs[~seen[docs]])
        at, step = end, 2 * step
        if not len(docs):
            continue
        seen[docs] = True
        score = s.scores(docs, weight)
        good = np.flatnonzero(score >= reach)
        if len(good) > 4 * top:
            # Equal scores at the edge stay: the smaller ids among them are chosen later.
            edge = np.partition(score[good], len(good) - top)[len(good) - top]
            good = good[score[good] >= edge]
        best = _best(best + [(int(score[k]), s.ids[docs[k]]) for k in good], top)
        if len(best) == top:
            reach = max(reach, best[-1][0])
    return best


_VECTORS = "doc_id long, n long, terms binary, counts binary"


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """doc_id, number of terms, and number and count of the terms that items ask for, of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        n, which, counts = [], [], []
        for text in part.column("text").to_pylist():
            words = terms(text)
            own = {known[w]: c for w, c in Counter(words).items() if w in known}
            n.append(len(words))
            which.append(np.fromiter(own.keys(), np.int32, len(own)).tobytes())
            counts.append(np.fromiter(own.values(), np.int32, len(own)).tobytes())
        arrays = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(which, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "terms", "counts"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), count, _VECTORS)


def _document_counts(vectors: DataFrame) -> dict[int, int]:
    """Documents of every term; at -1 the documents with a term, at -2 all terms of all documents."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter[int] = Counter()
        for part in parts:
            found = np.frombuffer(b"".join(part.column("terms").to_pylist()), np.int32)
            df.update(dict(zip(*(x.tolist() for x in np.unique(found, return_counts=True)), strict=True)))
            n = np.array(part.column("n").to_pylist(), np.int64)
            df[-1] += int((n > 0).sum())
            df[-2] += int(n.sum())
        yield pa.RecordBatch.from_arrays([pa.array(df.keys(), pa.int64()), pa.array(df.values(), pa.int64())], ["term", "n"])

    found = vectors.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in found.collect()}


def _searched(vectors: DataFrame, items: Items, weight: np.ndarray, docs: int, total: int, least: list[int], p: Search) -> DataFrame:
    """(item, doc_id, score): for each input partition the best documents of every item."""
    shared = vectors.sparkSession.sparkContext.broadcast((items, weight, least))

    def segments(parts: Iterator[pa.RecordBatch], vocabulary: int) -> Iterator[Segment]:
        held: list[tuple] = []
        entries = 0

        def made() -> Segment:
            which = np.frombuffer(b"".join(x[2] for x in held), np.int32).astype(np.int64)
            counts = np.frombuffer(b"".join(x[3] for x in held), np.int32)
            sizes = np.array([len(x[2]) // 4 for x in held])
            n = np.repeat(np.array([x[1] for x in held], np.int64), sizes)
            return Segment([x[0] for x in held], sizes, which, impacts(counts, n, docs, total), vocabulary, p)

        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if not row[2]:
                    continue
                held.append(row)
                entries += len(row[2]) // 4
                if len(held) >= p.segment_rows or entries >= p.segment_entries:
                    yield made()
                    held, entries = [], 0
        if held:
            yield made()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight, least = shared.value
        best: list[list[tuple]] = [[] for _ in own.numbers]
        scratch = np.zeros(len(weight), np.int64)
        for s in segments(parts, len(weight)):
            for k, (which, repeats) in enumerate(zip(own.terms, own.repeats, strict=True)):
                scratch[which] = weight[which] * repeats
                best[k] = search_segment(s, which, scratch, least[k], best[k], p.top)
                scratch[which] = 0
        rows = [(number, doc, score) for number, found in zip(own.numbers, best, strict=True) for score, doc in found]
        item, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (item, doc, score)], ["item", "doc_id", "score"])

    return _top(vectors.mapInArrow(run, "item long, doc_id long, score long"), p.top)


def _top(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _group(rows: list[Row]) -> tuple[Items, dict[bytes, int]]:
    vocabulary: dict[bytes, int] = {}
    which, repeats = [], []
    for r in rows:
        found = Counter(terms(r.text))
        which.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found], np.int64))
        repeats.append(np.array(list(found.values()), np.int64))
    return Items([r.item for r in rows], which, repeats), vocabulary


def search(
    docs: DataFrame,
    items: DataFrame,
    params: Search = Search(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``top`` documents with a score above 0.

    Scores and terms are those of ``impacts``, ``weights`` and ``terms``; they are exact integers. All documents
    count for the statistics and are searched. Each input partition is an index of its own,
    in segments of bounded size, so no list is too long for a task however common its
    term is. In a segment the posting list of a term is cut into blocks of similar
    documents (``Segment``), with the coordinatewise largest impacts of a block as its
    summary; a block is skipped only if the bound of its summary lies below a score that
    ``top`` documents are known to reach. Such scores come from the bounded first
    search, then from the partition itself, so the result does not depend on them.

    Every row of ``items`` is an item, rows that repeat an id or a text too. Every row of
    ``docs`` is a document; of equal scores the smaller id comes first, NULL ids last. NULL
    and empty texts have no terms. Whole texts count, however long. Columns besides the
    four are not read. Empty tables give an empty result.
    """
    p = params
    spark = docs.sparkSession
    python_workers(spark)
    asked = stored(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))).withColumn(
        "item", F.monotonically_increasing_id()
    )
    # Every second character at most begins a term.
    size = asked.agg(F.sum(F.ceil(F.length("text") / 4))).first()[0] or 0
    groups = max(1, math.ceil(size / p.item_terms))
    out = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for g in range(groups):
        own, vocabulary = _group(asked.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g).collect())
        if not vocabulary:
            continue
        vectors = stored(_vectors(docs, vocabulary, id_col, text_col))
        df = _document_counts(vectors)
        n, total = df.get(-1, 0), df.get(-2, 0)
        if not n:
            break
        weight = weights(np.array([df.get(k, 0) for k in range(len(vocabulary))]), n)
        part = min(1.0, 0.9 * p.first_rows / n)
        few = vectors.filter(F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 30)) < int(part * (1 << 30)))
        ahead = _searched(few.coalesce(4), own, weight, n, total, [1] * len(own.numbers), p)
        reached = {r.item: r.score for r in ahead.filter(F.col("rank") == p.top).collect()}
        least = [reached.get(i, 1) for i in own.numbers]
        out = out.unionByName(stored(_searched(vectors, own, weight, n, total, least, p)))
    named = asked.select(F.col("item").alias("a_item"), "item_id")
    return out.join(named, F.col("item") == F.col("a_item")).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
