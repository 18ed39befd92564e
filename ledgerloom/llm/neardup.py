"""Near duplicates by minhashes with tensored banding, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import bounded, fresh, map_batches, python_workers, release, stored
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import MinHasher, overlap, set_key, shingle_set


@dataclass(frozen=True)
class NearDup:
    """Shingle words, the least similarity in hundredths, and the tables.

    Two collections of ``half_keys`` keys of ``width`` minhashes each make
    half_keys ** 2 tables: table (i, j) has the i-th key of the first and the j-th of
    the second collection. 64 tables of 6 minhashes so need 48 minhashes, not 384. A
    pair is found if any key matches in both collections: at a similarity of 0.85
    with a probability of 0.9990, at 0.9 of 0.99994.

    ``least_equal`` of the minhashes must be equal before a pair is compared on whole
    sets: at 0.85 fewer are equal with a probability of 0.00002.
    """

    words: int = 5
    percent: int = 85
    half_keys: int = 8
    width: int = 3
    least_equal: int = 29

    @property
    def hashes(self) -> int:
        return 2 * self.half_keys * self.width


#: Rows of one block when the members of a table key are compared.
BLOCK = 1024
#: Members that are sent to one copy of a text they are compared with.
FAN = 256
#: Rows and numbers in their arrays that a task holds before it hands them on.
MOST_HELD = 200_000

_SKETCH = "doc_id long, text_key long, n_shingles long, h1 long, h2 long, halves array<long>, sketch binary"


def sketches(docs: DataFrame, p: NearDup, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: set size, a key that equal sets share, half keys, one byte of each minhash."""

    def sketch(part: pa.RecordBatch) -> pa.RecordBatch:
        hasher = MinHasher(p.hashes)
        sizes, h1, h2, halves, low = [], [], [], [], []
        for text in part.column("text").to_pylist():
            found = shingle_set(text, p.words)
            key = set_key(found)
            sizes.append(len(found))
            h1.append(key[0])
            h2.append(key[1])
            if not len(found):
                halves.append(None)
                low.append(None)
                continue
            mins = hasher(found)
            rows = mins.reshape(2 * p.half_keys, p.width)
            mixed = np.zeros(len(rows), np.uint64)
            for k in range(p.width):
                mixed = (mixed ^ rows[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            halves.append(mixed.view(np.int64))
            low.append((mins >> np.uint64(7)).astype(np.uint8).tobytes())
        arrays = [
            part.column("doc_id"), part.column("text_key"), pa.array(sizes, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
            pa.array(halves, pa.list_(pa.int64())), pa.array(low, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_key", "n_shingles", "h1", "h2", "halves", "sketch"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")
    )
    return map_batches(rows, sketch, _SKETCH)


def _members(classes: DataFrame, p: NearDup) -> DataFrame:
    """(node, least, key) for each class and every table in which another class can share its key.

    A key of a table pairs a half key of each collection, so it can be shared only if
    both halves are. Half keys are counted first, ``2 * half_keys`` rows for a class, and
    only shared ones are paired: a class that shares none has no row at all.
    """
    halves = classes.select("node", "least", F.posexplode("halves").alias("place", "half")).select(
        "node", "least", (F.col("place") < p.half_keys).alias("first"), F.xxhash64("place", "half").alias("half")
    )
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("uses")).filter("uses > 1").select("half")
    kept = halves.join(shared, "half").groupBy("node", "least").agg(
        *(F.collect_list(F.when(F.col("first") == side, F.col("half"))).alias(name) for name, side in (("a", True), ("b", False)))
    )
    pair = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    return kept.select("node", "least", F.explode(pair).alias("key"))


def _similar(p: NearDup):
    """Pairs of classes that can be similar: by the sizes of their sets and their equal minhashes."""

    def keep(part: pa.RecordBatch) -> pa.RecordBatch:
        if not part.num_rows:
            return part.select(["a", "b"])
        x, y = (
            np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, p.hashes) for c in ("s_a", "s_b")
        )
        ok = (x == y).sum(axis=1) >= p.least_equal
        return part.select(["a", "b"]).filter(pa.array(ok))

    return keep


def _first_pairs(hits: DataFrame, classes: DataFrame, p: NearDup) -> DataFrame:
    """Each class with the smallest one of every table key it shares."""
    pairs = hits.filter("node != low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    return _screened(pairs, classes, p)


def _screened(pairs: DataFrame, classes: DataFrame, p: NearDup) -> DataFrame:
    left, right = (
        classes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
        for c in ("a", "b")
    )
    sized = pairs.join(left, "a").join(right, "b").filter(
        100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b")
    )
    return map_batches(sized.select("a", "b", "s_a", "s_b"), _similar(p), "a long, b long")


def _blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows of every group of ``by`` that spans several components, dealt so that any two of them meet.

    Groups are cut into blocks, and every two blocks meet in a group (i, j) of at most
    2 * ``BLOCK`` rows, which lie together in a sorted stream.
    """
    groups = stored(
        rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y"))
        .filter("x != y").select(*by, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    block = F.pmod(F.hash("node"), F.col("blocks"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(other, block).alias("i"), F.greatest(other, block).alias("j")),
    )
    met = rows.join(bounded(groups, groups.count()), by).withColumn("block", block).withColumn("meet", F.explode(meets))
    key = [*by, "i", "j"]
    rest = [c for c in rows.columns if c not in by]
    return met.withColumns({"i": F.col("meet.i"), "j": F.col("meet.j")}).select(*key, "block", *rest).repartition(*key).sortWithinPartitions(*key)


def _met(dealt: DataFrame, keys: int, likely: Callable[[dict, int], np.ndarray]) -> DataFrame:
    """The pairs of a dealt group that are in different components and ``likely``.

    ``likely`` gets the columns of a group as arrays and a row, and says which of the
    rows after it can be similar to it.
    """
    names = dealt.columns

    def compare(group: list[tuple]) -> Iterator[tuple[int, int]]:
        columns = {c: np.array([g[k] for g in group]) for k, c in enumerate(names) if c != "sketch" and k >= keys}
        if "sketch" in names:
            at = names.index("sketch")
            columns["sketch"] = np.frombuffer(b"".join(g[at] for g in group), np.uint8).reshape(len(group), -1)
        node, part, side = columns["node"], columns["component"], columns["block"]
        across = group[0][keys - 2] != group[0][keys - 1]
        for k in range(len(group) - 1):
            ok = likely(columns, k) & (part[k + 1:] != part[k])
            if across:
                ok &= side[k + 1:] != side[k]
            for other in node[k + 1:][ok]:
                yield (int(max(other, node[k])), int(min(other, node[k])))

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: set[tuple[int, int]] = set()
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if held and held[0][:keys] != row[:keys]:
                    found.update(compare(held))
                    held = []
                held.append(row)
            if len(found) > 50_000:
                yield _pairs(found)
                found = set()
        found.update(compare(held))
        yield _pairs(found)

    python_workers(dealt.sparkSession)
    return dealt.mapInArrow(stream, "a long, b long")


#: Times that members are profiled against one of their key before the rest are compared on sketches.
ROUNDS = 1


def _left_over(shared: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """Pairs that share a table key, are in different components so far, and can be similar.

    The members of a key are profiled against one of them, and those near it are
    compared by what they differ in (``_by_differences``). Members far from it are
    compared on their sketches, or with more ``ROUNDS`` profiled against the smallest
    of their own first. By the triangle inequality of the distance
    1 - similarity, similar texts differ in their distance from a third by at most
    1 - percent / 100, so with zones that overlap by that much every pair is seen.
    """
    # With two members the only pair has been compared.
    members = shared.filter("n > 2").join(labels, F.col("node") == F.col("l_node"), "left").select(
        "key", "node", "least", F.coalesce("component", "node").alias("component")
    )
    found: list[DataFrame] = []
    for _ in range(ROUNDS):
        members, pairs = _round(members, classes, texts, p)
        found.append(pairs)

    def alike(c: dict, k: int) -> np.ndarray:
        n, x = c["n_shingles"], c["sketch"]
        ok = 100 * np.minimum(n[k + 1:], n[k]) >= p.percent * np.maximum(n[k + 1:], n[k])
        return ok & ((x[k + 1:] == x[k]).sum(axis=1) >= p.least_equal)

    sketched = _blocks(members.drop("least"), ["key"]).join(classes.select(F.col("node").alias("c_node"), "n_shingles", "sketch"), F.col("node") == F.col("c_node"))
    sketched = sketched.drop("c_node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found.append(_met(sketched, 3, alike))
    return reduce(DataFrame.unionByName, found).distinct()


def _round(members: DataFrame, classes: DataFrame, texts: DataFrame, p: NearDup) -> tuple[DataFrame, DataFrame]:
    """The members far from the smallest one of their key, and pairs among those near it."""
    keys = members.groupBy("key").agg(
        F.min(F.struct("least", "node", "component")).alias("low"), F.min("component").alias("x"), F.max("component").alias("y")
    ).filter("x != y")
    keys = stored(keys.select("key", F.col("low.node").alias("low"), F.col("low.component").alias("low_component")))
    hits = stored(members.join(bounded(keys, keys.count()), "key").filter("node != low"))
    pairs = hits.select(F.col("node").alias("a"), F.col("low").alias("b"), "component", "low_component").distinct()
    near_equal = p.hashes // 4

    def equal(part: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("s_a", "s_b"))
        close = (x == y).sum(axis=1) >= near_equal if part.num_rows else []
        names = ["a", "b", "component", "low_component"]
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(close, pa.bool_())], [*names, "close"])

    left, right = (classes.select(F.col("node").alias(c), F.col("sketch").alias(f"s_{c}")) for c in ("a", "b"))
    seen = stored(map_batches(
        pairs.join(left, "a").join(right, "b").select("a", "b", "component", "low_component", "s_a", "s_b"), equal,
        "a long, b long, component long, low_component long, close boolean",
    ))

    def differ(a: int, b: int, own: np.ndarray, base: np.ndarray, extra: int) -> tuple:
        both = overlap(own, base)
        union = len(own) + len(base) - both
        near, far = 100 * both >= (p.percent - 35) * union, 100 * both < 65 * union
        added = own[~np.isin(own, base, assume_unique=True)] if near else own[:0]
        lacking = base[~np.isin(base, own, assume_unique=True)] if near else own[:0]
        return a, b, near, far, len(own), len(base), added.view(np.int64), lacking.view(np.int64)

    ids = pa.list_(pa.int64())
    profiles = stored(_beside(
        seen.filter("close").select("a", "b", F.lit(0).cast("long").alias("extra")), classes, texts, p, differ,
        [("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_()), ("far", pa.bool_()), ("n", pa.int64()), ("of", pa.int64()), ("added", ids), ("lacking", ids)],
        "a long, b long, near boolean, far boolean, n long, of long, added array<long>, lacking array<long>",
    ))
    near = profiles.filter("near").join(seen.select("a", "b", "component"), ["a", "b"]).select("a", "b", "component", "n", "of", "added", "lacking")
    # The one of the key is a member that does not differ.
    lows = profiles.filter("near").groupBy("b").agg(F.first("of").alias("of")).join(seen.select("b", F.col("low_component").alias("component")).distinct(), "b")
    none = F.array().cast("array<long>")
    lows = lows.select(F.col("b").alias("a"), "b", "component", F.col("of").alias("n"), "of", none.alias("added"), none.alias("lacking"))
    close = _by_differences(near.unionByName(lows), p)
    distant = seen.filter("not close").select("a", "b").unionByName(profiles.filter("far").select("a", "b"))
    far = hits.join(distant, (F.col("node") == F.col("a")) & (F.col("low") == F.col("b"))).select("key", "node", "least", "component")
    return far, close


def _by_differences(near: DataFrame, p: NearDup) -> DataFrame:
    """Pairs of different components that can be similar, from what members add to and lack of a text b.

    The differences of most members are made part of the reference set: a common
    centre z. Let a member x lack R and add A relative to z. Two members share
    |z| - |Rx| - |Ry| + c shingles, where c counts the differences they have in common,
    so they are similar only if whole * c >= F(x) + F(y) - whole * |z| with
    whole = 100 + percent and F(x) = percent * |x| + whole * |Rx|.

    Let m have the least F. If that bound is 0 or less for any pair, it is for both
    with m: such members are paired with m alone. Every other pair has a member
    outside m's set, which bounds the other F from below and so gives each member
    the least c it needs: the pair must share one of its first |R| + |A| - c + 1
    differences, rarest first.
    """
    whole, q = 100 + p.percent, p.percent
    near = stored(near)
    sizes = stored(near.groupBy("b").agg(F.count(F.lit(1)).alias("members")))
    groups = sizes.count()

    def listed(added: str, lacking: str) -> Column:
        return F.explode(F.concat(
            F.transform(added, lambda e: F.struct(e.alias("element"), F.lit(True).alias("adds"))),
            F.transform(lacking, lambda e: F.struct(e.alias("element"), F.lit(False).alias("adds"))),
        ))

    uses = near.select("b", listed("added", "lacking").alias("e")).groupBy("b", "e.element", "e.adds").agg(F.count(F.lit(1)).alias("uses"))
    uses = stored(uses.join(bounded(sizes, groups), "b"))
    most = uses.filter("2 * uses > members").groupBy("b").agg(
        F.collect_list(F.when(F.col("adds"), F.col("element"))).alias("more"), F.collect_list(F.when(~F.col("adds"), F.col("element"))).alias("less")
    )
    none = F.array().cast("array<long>")
    # A row of ``most`` holds as many numbers as a document has shingles.
    centred = near.join(bounded(most, 100 * groups), "b", "left").withColumns({"more": F.coalesce("more", none), "less": F.coalesce("less", none)}).select(
        "a", "b", "component", "n",
        (F.col("of") + F.size("more") - F.size("less")).alias("z"),
        F.concat(F.array_except("added", "more"), F.array_except("less", "lacking")).alias("adds"),
        F.concat(F.array_except("lacking", "less"), F.array_except("more", "added")).alias("lacks"),
    )
    centred = stored(centred.withColumn("f", q * F.col("n") + whole * F.size("lacks")))
    least = stored(centred.groupBy("b").agg(F.min(F.struct("f", "a")).alias("m")))
    known = centred.join(bounded(least, groups), "b")
    bound = F.col("f") + F.col("m.f") - whole * F.col("z")
    sure = known.filter((bound <= 0) & (F.col("a") != F.col("m.a"))).select(
        F.greatest("a", "m.a").alias("a"), F.least("a", "m.a").alias("b")
    )
    d = F.size("adds") + F.size("lacks")
    needed = F.when(bound <= 0, F.floor((F.col("f") - F.col("m.f")) / whole) + 1).otherwise(F.ceil(bound / whole))
    rarity = uses.select("b", "element", F.least("uses", F.col("members") - F.col("uses")).alias("uses"))
    order = Window.partitionBy("b", "node").orderBy("uses", "element")
    postings = (
        known.select("b", F.col("a").alias("node"), "component", "n", (2 * F.col("f") - whole * F.col("z")).alias("f"), d.alias("d"),
                     needed.alias("needed"), F.explode(F.concat("adds", "lacks")).alias("element"))
        .filter("d >= needed")
        .join(rarity, ["b", "element"])
        .withColumn("rest", F.col("d") - F.row_number().over(order) + 1)
        .filter("rest >= needed")
        .select("b", "element", "node", "component", "n", "f", "rest")
    )

    def share(c: dict, k: int) -> np.ndarray:
        n, rest = c["n"], c["rest"]
        ok = 100 * np.minimum(n[k + 1:], n[k]) >= q * np.maximum(n[k + 1:], n[k])
        # If this is the first difference in common, at most the rest of the shorter list is.
        return ok & (2 * whole * np.minimum(rest[k + 1:], rest[k]) >= c["f"][k + 1:] + c["f"][k])

    return sure.unionByName(_met(_blocks(stored(postings), ["b", "element"]), 4, share))


def _pairs(found: set[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _beside(
    pairs: DataFrame, classes: DataFrame, texts: DataFrame, p: NearDup,
    visit: Callable[[int, int, np.ndarray, np.ndarray, int], tuple | None], columns: list[tuple[str, pa.DataType]], schema: str,
) -> DataFrame:
    """``visit`` (a, b, set of a, set of b, extra) for every pair, where it returns a row.

    ``pairs`` (a, b, extra) is stored. Each b gets a copy of its text for every ``FAN`` of
    its partners; the partners of a copy follow it in a sorted stream, so one set is held
    at a time.
    """
    fans = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("fans"))
    dealt = stored(pairs.join(fans, "b").select("a", "b", "extra", F.pmod(F.hash("a"), F.col("fans")).alias("fan")))
    wanted = dealt.select(F.col("a").alias("node"), "b", "fan", F.lit(1).alias("turn"), "extra").unionByName(
        dealt.select(F.col("b").alias("node"), "b", "fan", F.lit(0).alias("turn"), F.lit(0).cast("long").alias("extra")).distinct()
    ).join(classes.select("node", "least", "h1", "h2"), "node")
    rows = bounded(wanted, 2 * dealt.count()).join(texts, F.col("least") == F.col("t_id")).select(
        "b", "fan", "turn", "node", "extra", "h1", "h2", "text"
    ).repartition("b", "fan").sortWithinPartitions("b", "fan", "turn")

    def batch(found: list[tuple]) -> pa.RecordBatch:
        by_column = list(zip(*found, strict=True)) if found else [()] * len(columns)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(by_column, columns, strict=True)], [c for c, _ in columns])

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, base, size = None, None, 0
        found: dict[tuple[int, int], tuple] = {}
        for part in parts:
            for b, fan, turn, node, extra, h1, h2, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                own = shingle_set(text, p.words)
                # A document that repeats an id has several texts; its class tells which is meant.
                if set_key(own) != (h1, h2):
                    continue
                if not turn:
                    at, base = (b, fan), own
                elif at == (b, fan) and (row := visit(node, b, own, base, extra)) is not None:
                    found[node, b] = row
                    size += 1 + sum(len(x) for x in row if isinstance(x, np.ndarray))
                    if size > MOST_HELD:
                        yield batch(list(found.values()))
                        found, size = {}, 0
        yield batch(list(found.values()))

    python_workers(rows.sparkSession)
    return rows.mapInArrow(stream, schema)


def confirmed(pairs: DataFrame, classes: DataFrame, texts: DataFrame, p: NearDup) -> DataFrame:
    """The pairs (a, b), a stored table, whose whole shingle sets are similar enough."""

    def linked(a: int, b: int, own: np.ndarray, base: np.ndarray, extra: int) -> tuple | None:
        both = overlap(own, base)
        return (a, b) if 100 * both >= p.percent * (len(own) + len(base) - both) else None

    with_extra = pairs.select("a", "b", F.lit(0).cast("long").alias("extra"))
    return _beside(with_extra, classes, texts, p, linked, [("a", pa.int64()), ("b", pa.int64())], "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, params: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and text_key (a hash of the text) of every row.

    Texts are linked when 100 * intersection >= percent * union of their sets of
    distinct word shingles; component_id is the smallest id reachable by links.
    Equal sets form a class that stands for all its rows, so copies are never
    compared with each other. Classes meet in the tables of ``NearDup``:

    1. each is compared with the smallest class of every table key it shares;
    2. keys whose members are still in several components have their other pairs
       compared by what the members differ in from that class (``_left_over``).

    So any pair that shares a table key ends in one component if it is linked,
    whatever the size of its group; candidates are confirmed on whole sets. Empty
    texts (NULL, no words) are linked with nothing: component_id is their own id.
    Rows without an id are linked with nothing and kept, with a NULL component.
    Rows that repeat an id are told apart by text: each has the component of its own
    text. An empty table gives an empty result.
    """
    p = params
    rows = stored(sketches(docs, p, id_col, text_col))
    usable = rows.filter("n_shingles > 0 and doc_id is not null")
    # A class is a node of its own, not one of its ids: an id with two texts is in two classes.
    classes = stored(usable.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("halves").alias("halves"), F.first("sketch").alias("sketch"),
    )).withColumn("node", F.monotonically_increasing_id())
    texts = docs.select(F.col(id_col).cast("long").alias("t_id"), F.col(text_col).alias("text"))
    members = stored(_members(classes, p))
    # The one of the smallest id is often the text of which the others are copies.
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("least", "node")).alias("low"))
    buckets = stored(buckets.filter("n > 1").select("key", "n", F.col("low.node").alias("low")))
    hits = stored(members.join(bounded(buckets, buckets.count()), "key"))
    release(members)
    first = stored(_first_pairs(hits, classes, p))
    labels = components(confirmed(first, classes, texts, p))
    more = _left_over(hits, classes, labels.select(F.col("node").alias("l_node"), "component"), texts, p)
    rest = stored(_screened(more.join(first, ["a", "b"], "left_anti"), classes, p))
    release(hits)
    if not rest.isEmpty():
        known = labels.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = components(known.unionByName(confirmed(rest, classes, texts, p)))
    labelled = classes.select("h1", "h2", "least", "node").join(labels.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left")
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id")).filter("component is not null")
    named = labelled.join(smallest, "component", "left").select("h1", "h2", F.coalesce("component_id", "least").alias("component_id"))
    matched = usable.join(named, ["h1", "h2"]).select("doc_id", "text_key", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return matched.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(
    docs: DataFrame, params: NearDup = NearDup(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their component.

    Rows with the same id and text are one document: one of them stays. Rows without
    an id stay.
    """
    found = stored(near_duplicates(docs, params, id_col, text_col).select("doc_id", "text_key", "kept"))
    id_, text_key = fresh(docs, "found_id", "found_key")
    key = [F.col(id_col).cast("long").eqNullSafe(F.col(id_)), F.xxhash64(text_col) == F.col(text_key)]

    def marked(rows: DataFrame) -> DataFrame:
        few = stored(rows.select(F.col("doc_id").alias(id_), F.col("text_key").alias(text_key)))
        return bounded(few, few.count())

    left = docs.join(marked(found.filter("not kept").distinct()), key, "left_anti")
    again = found.filter("kept and doc_id is not null").groupBy("doc_id", "text_key").count().filter("count > 1")
    if again.isEmpty():
        return left
    twice = marked(again)
    one = left.join(twice, key, "left_semi").withColumn(text_key, F.xxhash64(text_col)).dropDuplicates([id_col, text_key]).drop(text_key)
    return left.join(twice, key, "left_anti").unionByName(one)
