"""Hard negatives of embeddings by best-first search in R-trees packed by sort, tile, recurse."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from ledgerloom.llm.common import map_batches, python_workers, stored


@dataclass(frozen=True)
class Mining:
    """What is mined, and how the trees are cut.

    Tiles are cut at quantiles of at most ``fit_rows`` sampled rows; every row is
    indexed. A tile is packed in trees of at most ``tree_rows`` rows, with leaves of
    ``leaf_rows`` and nodes of ``fanout`` children. About ``anchor_rows`` anchors search at a
    time; these and their scores to reach are what a task is sent.
    """

    positives: int = 5
    negatives: int = 3
    #: Scores of negatives in hundredths of the score of the positive.
    low: int = 50
    high: int = 95
    tree_rows: int = 16_384
    leaf_rows: int = 128
    fanout: int = 8
    fit_rows: int = 10_000
    anchor_rows: int = 8_192
    seed: int = 29


def _slices(tiles: int, dims: int) -> tuple[int, int]:
    """Coordinates to slice and slices of each: as many coordinates as get two slices at least."""
    used = min(dims, int(math.log2(tiles))) if tiles > 1 else 0
    return used, math.ceil(tiles ** (1 / used) - 1e-9) if used else 1


@dataclass(frozen=True)
class Cuts:
    """Sort, tile, recurse over all rows: for each level the coordinate and the cuts of every slab so far."""

    coordinates: list[int]
    cuts: list[np.ndarray]

    def tile(self, keys: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """The tile of every row. ``spread``, in [0, 1), tells equal (integer) keys apart."""
        at = np.zeros(len(keys), np.int64)
        for c, cuts in zip(self.coordinates, self.cuts, strict=True):
            at = at * (cuts.shape[1] + 1) + ((keys[:, c] + spread)[:, None] > cuts[at]).sum(axis=1)
        return at


def fit(keys: np.ndarray, spread: np.ndarray, tiles: int) -> Cuts:
    """Cuts into about ``tiles`` tiles at quantiles of sampled rows: the first coordinate, then those that vary most."""
    width = keys.shape[1]
    order = [0, *(1 + np.argsort(-keys[:, 1:].var(axis=0), kind="stable")).tolist()] if len(keys) else list(range(width))
    used, slices = _slices(min(tiles, max(1, len(keys) // 8)), width)
    at, cuts = np.zeros(len(keys), np.int64), []
    for level, c in enumerate(order[:used]):
        x = keys[:, c] + spread
        own = [x[at == slab] for slab in range(slices**level)]
        cuts.append(np.array([np.quantile(v if len(v) else x, np.arange(1, slices) / slices) for v in own]))
        at = at * slices + (x[:, None] > cuts[-1][at]).sum(axis=1)
    return Cuts(order[:used], cuts)


def packed(keys: np.ndarray, leaf_rows: int) -> np.ndarray:
    """An order of the rows in which every run of ``leaf_rows`` is a leaf: sort by a coordinate, cut into slabs, recurse."""
    order = [0, *(1 + np.argsort(-keys[:, 1:].var(axis=0), kind="stable")).tolist()]
    leaves = -(-len(keys) // leaf_rows)
    used, slices = _slices(leaves, keys.shape[1])

    def pack(rows: np.ndarray, level: int) -> list[np.ndarray]:
        if level == used or len(rows) <= leaf_rows:
            return [rows]
        rows = rows[np.argsort(keys[rows, order[level]], kind="stable")]
        slab = leaf_rows * max(1, slices ** (used - level - 1))
        return [x for k in range(0, len(rows), slab) for x in pack(rows[k:k + slab], level + 1)]

    return np.concatenate(pack(np.arange(len(keys)), 0))


class Tree:
    """Rows in packed order under boxes: leaves first, then each level above, the root last.

    A box has the least and largest label and coordinates of its rows.
    """

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, rows: np.ndarray, p: Mining):
        self.ids, self.keys, self.labels, self.rows, self.leaf_rows = ids, keys, labels, rows, p.leaf_rows
        least, most = (labels[:, None], rows), (labels[:, None], rows)
        self.leaves, self.children, levels, first, step = -(-len(rows) // p.leaf_rows), [], [], -len(rows), p.leaf_rows
        while not levels or len(levels[-1][0][0]) > 1:
            size = len(least[0])
            starts = np.arange(0, size, step)
            if levels:
                self.children += [range(first + k, first + min(k + step, size)) for k in starts.tolist()]
            else:
                self.children += [range(0)] * len(starts)
            least, most = (tuple(np.minimum.reduceat(x, starts) for x in least), tuple(np.maximum.reduceat(x, starts) for x in most))
            levels.append((least, most))
            first, step = first + size, p.fanout
        (self.label_low, self.low), (self.label_high, self.high) = (
            tuple(np.concatenate([level[side][k] for level in levels]) for k in (0, 1)) for side in (0, 1)
        )
        self.label_low, self.label_high = self.label_low[:, 0], self.label_high[:, 0]

    def intervals(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Between what the inner product with every anchor lies in every box: the sums of each coordinate's interval."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.low.T + down @ self.high.T, up @ self.high.T + down @ self.low.T


@dataclass
class Wanted:
    """What an anchor looks for: the first ``k`` rows in each of several score windows, and those found so far.

    ``same`` asks for rows of the anchor's label other than itself, else for rows of other labels.
    """

    number: int
    label: int
    same: bool
    k: int
    low: np.ndarray
    high: np.ndarray

    def __post_init__(self) -> None:
        self.found: list[list[tuple]] = [[] for _ in self.low]
        #: A score below this can no longer be among the first of a window.
        self.reach = self.low.copy()

    def add(self, scores: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        hits = (scores >= self.reach[:, None]) & (scores <= self.high[:, None])
        for w in np.flatnonzero(hits.any(axis=1)).tolist():
            at = np.flatnonzero(hits[w])
            at = at[np.lexsort((keys[at], ids[at], -scores[at]))[:self.k]]
            new = list(zip((-scores[at]).tolist(), ids[at].tolist(), keys[at].tolist(), strict=True))
            self.found[w] = sorted(self.found[w] + new)[:self.k]
            if len(self.found[w]) == self.k:
                self.reach[w] = -self.found[w][-1][0]


def best_first(tree: Tree, anchor: np.ndarray, want: Wanted, low: np.ndarray, high: np.ndarray) -> int:
    """Search a tree by falling upper bounds; returns how many leaves were read.

    A box is pruned if its labels do not fit, or if for every window its interval lies
    outside or its upper bound is strictly below the k-th score: an equal score can still
    win by its id.
    """

    def live(node: int) -> bool:
        if want.same:
            fits = tree.label_low[node] <= want.label <= tree.label_high[node]
        else:
            fits = not tree.label_low[node] == want.label == tree.label_high[node]
        return fits and bool(((low[node] <= want.high) & (high[node] >= want.reach)).any())

    root, read = len(high) - 1, 0
    queue = [(-high[root], root)] if live(root) else []
    while queue:
        bound, node = heapq.heappop(queue)
        if -bound < want.reach.min():
            break
        if not live(node):
            continue
        if node >= tree.leaves:
            for child in tree.children[node]:
                if live(child):
                    heapq.heappush(queue, (-high[child], child))
            continue
        read += 1
        rows = slice(node * tree.leaf_rows, (node + 1) * tree.leaf_rows)
        scores, ids, keys = tree.rows[rows] @ anchor, tree.ids[rows], tree.keys[rows]
        fit_ = tree.labels[rows] == want.label
        fit_ = fit_ & (keys != want.number) if want.same else ~fit_
        want.add(scores[fit_], ids[fit_], keys[fit_])
    return read


_TREE = "width int, ids binary, keys binary, labels binary, rows binary"


def _exact(*sets: np.ndarray) -> list[np.ndarray]:
    """The integers as floats where every sum of their products is exact, else as whole numbers of any size."""
    most = math.prod(max(1, int(np.abs(x).max(initial=0))) for x in sets[:2])
    kind = np.float64 if most * max(1, sets[0].shape[1]) < 1 << 53 else object
    return [x.astype(kind) for x in sets]


def _trees(rows: DataFrame, p: Mining) -> DataFrame:
    """Every tile's rows in trees, a row for each, as files."""
    count = rows.count()
    chosen = F.pmod(F.xxhash64("key", F.lit(p.seed)), F.lit(1 << 30)) < int(min(1.0, 0.9 * p.fit_rows / max(1, count)) * (1 << 30))
    taken = rows.filter(chosen).select("key", "label", "vector").limit(p.fit_rows).collect()
    by_width: dict[int, list[Row]] = {}
    for r in taken:
        by_width.setdefault(len(r.vector), []).append(r)
    tiles = -(-count // p.tree_rows)
    fitted = {}
    for width, own in by_width.items():
        keys = np.array([[r.label, *r.vector] for r in own], np.float64)
        fitted[width] = fit(keys, _spread(np.array([r.key for r in own])), -(-tiles * len(own) // len(taken)))
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def place(part: pa.RecordBatch) -> pa.RecordBatch:
        vectors, labels, keys = (part.column(c).to_pylist() for c in ("vector", "label", "key"))
        tile = [0] * len(vectors)
        groups: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            groups.setdefault(len(v), []).append(i)
        for width, at in groups.items():
            if width in shared.value:
                own = np.array([[labels[i], *vectors[i]] for i in at], np.float64)
                for i, t in zip(at, shared.value[width].tile(own, _spread(np.array([keys[i] for i in at]))).tolist(), strict=True):
                    tile[i] = t
        widths = pa.array([len(v) for v in vectors], pa.int32())
        whole = [np.array(v, np.int64).tobytes() for v in vectors]
        return pa.RecordBatch.from_arrays(
            [widths, pa.array(tile, pa.int64()), part.column("vec_id"), part.column("key"), part.column("label"), pa.array(whole, pa.binary())],
            ["width", "tile", "vec_id", "key", "label", "vector"],
        )

    placed = map_batches(rows, place, "width int, tile long, vec_id long, key long, label long, vector binary")

    def pack(held: list[tuple]) -> pa.RecordBatch:
        width = held[0][0]
        ids, keys, labels = (np.array([h[k] for h in held], np.int64) for k in (2, 3, 4))
        vectors = np.frombuffer(b"".join(h[5] for h in held), np.int64).reshape(len(held), width)
        order = packed(np.concatenate([labels[:, None], vectors], axis=1).astype(np.float64), p.leaf_rows)
        columns = [x[order].tobytes() for x in (ids, keys, labels)]
        rows = vectors[order]
        rows = rows.astype(np.int16 if np.abs(rows).max(initial=0) < 1 << 15 else np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([width], pa.int32()), *(pa.array([x], pa.binary()) for x in (*columns, rows.tobytes()))],
            ["width", "ids", "keys", "labels", "rows"],
        )

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if held and (held[0][:2] != row[:2] or len(held) == p.tree_rows):
                    yield pack(held)
                    held = []
                held.append(row)
        if held:
            yield pack(held)

    return stored(placed.repartition("width", "tile").sortWithinPartitions("width", "tile", "key").mapInArrow(stream, _TREE))


def _spread(keys: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each key, evenly dealt."""
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / float(1 << 53)


def _found(trees: DataFrame, anchors: list[Row], windows: dict[int, list[tuple[int, int]]] | None, p: Mining) -> DataFrame:
    """(anchor, slot, rank, score, vec_id, key): an anchor's first rows in each of its windows.

    Without windows: the first rows of its own label.
    """
    k = p.positives if windows is None else p.negatives
    asked = [(r.key, r.label, r.vector, [(None, None)] if windows is None else windows.get(r.key, [])) for r in anchors]
    shared = trees.sparkSession.sparkContext.broadcast([x for x in asked if x[3]])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width: dict[int, list[tuple]] = {}
        for number, label, vector, bounds in shared.value:
            low, high = (np.array([edge if b[e] is None else b[e] for b in bounds], object) for e, edge in ((0, -math.inf), (1, math.inf)))
            want = Wanted(number, label, windows is None, k, low, high)
            by_width.setdefault(len(vector), []).append((want, vector))
        for part in parts:
            for row in part.to_pylist():
                own = by_width.get(row["width"], [])
                if not own:
                    continue
                ids, keys, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels"))
                kind = np.int16 if len(row["rows"]) == 2 * len(ids) * row["width"] else np.int64
                rows = np.frombuffer(row["rows"], kind).reshape(len(ids), row["width"])
                a, rows = _exact(np.array([v for _, v in own], np.int64).reshape(len(own), row["width"]), rows.astype(np.int64))
                tree = Tree(ids, keys, labels, rows, p)
                for at in range(0, len(own), 512):
                    low, high = tree.intervals(a[at:at + 512])
                    for i, (want, _) in enumerate(own[at:at + 512]):
                        want.low, want.high, want.reach = (x.astype(a.dtype) for x in (want.low, want.high, want.reach))
                        best_first(tree, a[at + i], want, low[i], high[i])
        out = [
            (want.number, slot, int(-score), id_, key)
            for own in by_width.values() for want, _ in own for slot, found in enumerate(want.found) for score, id_, key in found
        ]
        columns = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "slot", "score", "vec_id", "key"])

    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id", "key")
    found = trees.mapInArrow(search, "anchor long, slot long, score long, vec_id long, key long")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _usable(table: DataFrame, id_col: str, vector_col: str, label_col: str, relabel: Column | None) -> DataFrame:
    v = F.col("v")
    base = table.select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col).cast("long") if relabel is None else relabel).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = base.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
    whole = F.transform("v", lambda x: F.when(F.abs(x) < F.lit(2.0**54), F.floor(x * 256)).otherwise(
        F.raise_error(F.lit("a component is too large for a 64-bit score")).cast("long")
    ))
    return stored(rows.select("vec_id", "label", whole.alias("vector"))).withColumn("key", F.monotonically_increasing_id())


def hard_negatives(
    table: DataFrame,
    anchors: Column | None = None,
    params: Mining = Mining(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    relabel: Column | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components count as floor(256 * x) and a score is the exact integer inner product
    of two rows. ``anchors`` is a condition on vec_id and label (default: vec_id divisible
    by 50), ``relabel`` an expression of the table's columns for the label. An
    anchor's positives are its first other rows of the same label; for each of these
    the first rows of other labels with low * positive_score <= 100 * negative_score <=
    high * positive_score are returned. Higher scores come first, then smaller ids.

    All rows are packed in R-trees whose first coordinate is the label, tile by tile. An
    anchor searches every tree best-first and leaves out what its boxes exclude;
    what it has found in one tree of a partition bounds the search in the next. Anchors are
    taken in blocks, each with two passes over the trees: positives, then all windows of
    an anchor at once. A hot label or vector is dealt over many trees, as equal
    coordinates are told apart by the row's number.

    Rows with a NULL id, label or vector or any NULL or non-finite component take no
    part. Vectors of another length than the anchor's are not compared with it. Rows
    that repeat an id are rows of their own: copies of an anchor are anchors, and are
    positives of one another. Large components are multiplied as whole numbers of any
    size; one of 2**54 or more, or a score beyond 64 bits, fails with an error. Other columns are not read. An empty
    table gives an empty result.
    """
    p = params
    spark = table.sparkSession
    python_workers(spark)
    rows = _usable(table, id_col, vector_col, label_col, relabel)
    trees = _trees(rows, p)
    own = stored(rows.filter(F.col("vec_id") % 50 == 0 if anchors is None else anchors))
    blocks = max(1, -(-own.count() // p.anchor_rows))
    out = []
    for b in range(blocks):
        block = own.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()
        positives = stored(_found(trees, block, None, p).select("anchor", (F.col("rank") - 1).cast("long").alias("slot"), "score", "vec_id"))
        windows: dict[int, list[tuple[int, int]]] = {}
        for r in positives.orderBy("anchor", "slot").collect():
            windows.setdefault(r.anchor, []).append((-(-p.low * r.score // 100), p.high * r.score // 100))
        negatives = _found(trees, block, windows, p).select("anchor", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        named = negatives.join(positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["anchor", "slot"])
        out.append(stored(named.join(own.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")))
    return reduce(DataFrame.unionByName, out).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
