"""Near duplicates among embeddings by a forest of random-projection trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import bounded, map_batches, python_workers, stored
from ledgerloom.llm.components import components


@dataclass(frozen=True)
class Forest:
    """Trees, rows of a leaf, the part of a node on each side of a split that goes to both
    children, and the rows on which splits are fitted (``fit_rows`` at most; every row is indexed).
    At most as many rows are centres of the cells of large components.

    Levels beyond those that ``fit_rows`` can fit are fitted in Spark, ``step`` at a time, each
    node on a sample of its own rows, so leaves stay near ``leaf_rows`` at every size.
    """

    trees: int = 8
    leaf_rows: int = 256
    spill: float = 0.06
    fit_rows: int = 20_000
    #: Rows of a block when a leaf or a cell is compared.
    block: int = 2_048
    #: Levels of a deeper part of a tree; its bounds are 2 * (2^step - 1) numbers a node.
    step: int = 6
    seed: int = 23


@dataclass(frozen=True)
class Fitted:
    """A direction for each tree and level; for each tree and level the two bounds of every node's split.

    A row goes left below ``upper`` and right above ``lower``, so rows between them
    go both ways.
    """

    directions: np.ndarray
    lower: list[list[np.ndarray]]
    upper: list[list[np.ndarray]]

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def leaves(self, rows: np.ndarray) -> list[list[int]]:
        """The leaves of every (unit) row over all trees, as numbers."""
        out: list[list[int]] = [[] for _ in range(len(rows))]
        for t in range(len(self.directions)):
            row, node = descend(rows @ self.directions[t, :, :rows.shape[1]].T, self.lower[t], self.upper[t])
            for r, n in zip(row.tolist(), ((t << self.depth) + node).tolist(), strict=True):
                out[r].append(n)
        return out


def descend(position: np.ndarray, lower: list[np.ndarray], upper: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every row, given its position along the direction of each level."""
    row, node = np.arange(len(position)), np.zeros(len(position), np.int64)
    for level in range(len(lower)):
        at = position[row, level]
        left, right = at <= upper[level][node], at >= lower[level][node]
        row, node = np.concatenate([row[left], row[right]]), np.concatenate([2 * node[left], 2 * node[right] + 1])
    return row, node


def split(position: np.ndarray, spill: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The bounds of every node of a tree whose nodes split at the median of their rows.

    A node without rows splits like the root.
    """
    node = np.zeros(len(position), np.int64)
    lower, upper = [], []
    for level in range(position.shape[1]):
        at = position[:, level]
        low, high, middle = (np.zeros(1 << level) for _ in range(3))
        order = np.argsort(node, kind="stable")
        cuts = np.searchsorted(node[order], np.arange((1 << level) + 1))
        for n in range(1 << level):
            own = at[order[cuts[n]:cuts[n + 1]]]
            own = own if len(own) else at
            low[n], middle[n], high[n] = np.quantile(own, [0.5 - spill, 0.5, 0.5 + spill])
        node = 2 * node + (at > middle[node])
        lower.append(low)
        upper.append(high)
    return lower, upper


def levels(rows: int, p: Forest) -> int:
    """The levels that ``rows`` need for leaves of ``leaf_rows``."""
    return int(np.ceil(np.log2(max(1, rows / p.leaf_rows))))


def deeper(seed: int, tree: int, first: int, depth: int, width: int) -> np.ndarray:
    """The directions of a tree's ``depth`` levels from level ``first`` on."""
    return np.random.default_rng([seed, tree, first]).standard_normal((depth, width))


def fit(sample: np.ndarray, rows: int, p: Forest) -> Fitted:
    """Split at the median of the sample rows in a node, along a random direction for each level.

    A tree is as deep as ``rows`` need for leaves of ``leaf_rows``, while a node has
    four sample rows to split; deeper levels are those of ``_deepened``.
    """
    rng = np.random.default_rng(p.seed)
    depth = max(0, min(levels(rows, p), int(np.log2(max(1, len(sample) / 4)))))
    directions = rng.standard_normal((p.trees, depth, sample.shape[1]))
    lower, upper = [], []
    for t in range(p.trees):
        lows, highs = split(sample @ directions[t].T, p.spill)
        lower.append(lows)
        upper.append(highs)
    return Fitted(directions, lower, upper)


def _unit(vectors: list) -> np.ndarray:
    rows = np.asarray(vectors, np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def near_vectors(
    table: DataFrame,
    least: float = 0.95,
    params: Forest = Forest(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows are linked when their cosine, in double precision, is ``least`` or more.
    n_links counts the other rows linked directly, component_id is the smallest id
    reachable by links. Equal vectors form a class that stands for all its rows.
    Classes meet in the leaves of the forest, whose links give the components. As a
    link lies within a component, all pairs of a component are then compared and
    counted, each once: n_links misses no link between rows of a component, however
    the leaves have cut a large group of near copies (see ``_in_components``). A
    leaf or cell with more than ``block`` rows is dealt into blocks of which every
    two meet.

    Vectors that are NULL, zero or hold NULL or non-finite numbers link with nothing,
    nor do vectors of different lengths. Rows without an id link with nothing and
    are kept, with a NULL component. Rows that repeat an id count as rows of their
    own. An empty table gives an empty result.
    """
    p = params
    v = F.col("v")
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    base = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(vector_col).alias("raw"))
    # A NULL or non-finite component makes the sum NULL or non-finite.
    fine = F.coalesce((squares > 0) & (squares < F.lit(float("inf"))), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = stored(base.select(
        "vec_id", fine.alias("fine"), F.when(fine, F.col("raw")).alias("vector"),
        F.when(fine, F.xxhash64("v")).alias("h1"), F.when(fine, F.xxhash64(F.lit(1), "v")).alias("h2"),
    ))
    usable = rows.filter("fine")
    # A class is a node of its own, not one of its ids: an id with two vectors is in two classes.
    classes = stored(usable.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"),
    )).withColumn("node", F.monotonically_increasing_id())
    n = classes.count()
    found = stored(_in_leaves(classes, n, least, p))
    labels = stored(components(found.select(F.col("node").alias("a"), F.col("low").alias("b"))))
    members = stored(classes.select("node", "copies", "vector").join(labels, "node"))
    more = _in_components(members, least, p).groupBy("node").agg(F.sum("links").alias("more"))
    labelled = classes.select("h1", "h2", "node", "copies", F.col("least").alias("own")).join(
        labels.withColumnRenamed("node", "l_node"), F.col("node") == F.col("l_node"), "left"
    )
    smallest = labelled.groupBy("component").agg(F.min("own").alias("component_id")).filter("component is not null")
    named = labelled.join(more, "node", "left").join(smallest, "component", "left").select(
        "h1", "h2",
        (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component_id", "own").alias("component_id"),
    )
    matched = usable.join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return matched.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _fit(classes: DataFrame, n: int, p: Forest) -> Fitted:
    # A seeded part of the rows, at most ``fit_rows`` of them on the driver.
    part = min(1.0, 0.9 * p.fit_rows / max(1, n))
    chosen = F.pmod(F.xxhash64("h1", F.lit(p.seed)), F.lit(1 << 30)) < int(part * (1 << 30))
    taken = classes.filter(chosen).select("vector").limit(p.fit_rows).collect()
    width = max((len(r.vector) for r in taken), default=1)
    whole = [r.vector for r in taken if len(r.vector) == width]
    return fit(_unit(whole) if whole else np.zeros((1, width)), n, p)


def _in_leaves(classes: DataFrame, n: int, least: float, p: Forest) -> DataFrame:
    """(node, low): what the links found in a leaf connect, as links to one node of each connected part."""
    first = _fit(classes, n, p)
    shared = classes.sparkSession.sparkContext.broadcast(first)

    def place(part: pa.RecordBatch) -> pa.RecordBatch:
        vectors = part.column("vector").to_pylist()
        leaves: list[list[int]] = [[] for _ in vectors]
        by_width: dict[int, list[int]] = {}
        fitted = shared.value
        for i, x in enumerate(vectors):
            by_width.setdefault(len(x), []).append(i)
        for width, at in by_width.items():
            own = _unit([vectors[i] for i in at])[:, :fitted.directions.shape[2]]
            for i, found in zip(at, fitted.leaves(own), strict=True):
                leaves[i] = [_leaf_number(x, width) for x in sorted(found)]
        return pa.RecordBatch.from_arrays(
            [part.column("node"), part.column("vector"), pa.array(leaves, pa.list_(pa.int64()))], ["node", "vector", "leaves"]
        )

    kind = classes.schema["vector"].dataType.simpleString()
    placed = map_batches(classes.select("node", "vector"), place, f"node long, vector {kind}, leaves array<long>")
    at = first.depth
    while at < levels(n, p):
        depth = min(p.step, levels(n, p) - at)
        placed = _deepened(placed, at, depth, p)
        at += depth
    sizes = stored(placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(
        F.ceil(F.count(F.lit(1)) / p.block).cast("int").alias("blocks")
    ))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        placed.withColumn("leaf", F.explode("leaves"))
        .join(bounded(sizes, sizes.count()), "leaf")
        .withColumn("block", block)
        .withColumn("meet", F.explode(_meets(F.col("blocks"))))
        .select(F.lit(0).alias("part"), "leaf", "meet.i", "meet.j", "block", "node", "vector")
        .repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")
    )

    def connected(group: list[tuple]) -> list[tuple]:
        node, label = [g[5] for g in group], np.arange(len(group))
        for x, y, hit in _hits(group, 6, least):
            a, b = np.nonzero(hit)
            _merge(label, x[a], y[b])
        return [(node[k], node[to]) for k, to in enumerate(label.tolist()) if k != to]

    return _by_group(dealt, connected, ["node", "low"])


def _leaf_number(leaf: int, width: int) -> int:
    """A leaf as a number that also tells vectors of different lengths apart."""
    return (leaf << 16) + min(width, 65535)


def _deepened(placed: DataFrame, at: int, depth: int, p: Forest) -> DataFrame:
    """``placed`` with every leaf of level ``at`` split by ``depth`` levels more.

    A leaf is fitted on a sample of its own rows, about four for each of its new
    leaves as in ``fit``, drawn by the hash of a row and gathered in Spark: neither the
    driver nor a task holds more than a leaf's sample. A leaf with few rows is left
    whole. The bounds join the rows by leaf, and Spark chooses how by their size.
    """
    want = 4 << depth
    kind = placed.schema["vector"].dataType.simpleString()
    rows = stored(placed.withColumn("leaf", F.explode("leaves")).select("leaf", "node", "vector"))
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > p.leaf_rows)
    drawn = F.pmod(F.xxhash64("node", "leaf", F.lit(p.seed + at)), F.lit(1 << 30)) < F.lit(float(want) * (1 << 30)) / F.col("n")
    sample = rows.join(sizes, "leaf").filter(drawn).select("leaf", "vector").repartition("leaf").sortWithinPartitions("leaf")

    def directions(leaf: int, width: int) -> np.ndarray:
        return deeper(p.seed, (leaf >> 16) >> at, at, depth, width)

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def bounds() -> pa.RecordBatch:
            own = [v for _, v in held if len(v) == len(held[0][1])] if held else []
            found = split(_unit(own) @ directions(held[0][0], len(own[0])).T, p.spill) if own else ()
            columns = [[held[0][0]]] + [[np.concatenate(side).tolist()] for side in found] if own else [[], [], []]
            kinds = (pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["leaf", "lower", "upper"])

        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield bounds()
                    held = []
                held.append(row)
        yield bounds()

    def place(part: pa.RecordBatch) -> pa.RecordBatch:
        leaf, vectors, lower, upper = (part.column(c).to_pylist() for c in ("leaf", "vector", "lower", "upper"))
        out: list[list[int]] = [[] for _ in leaf]
        together: dict[tuple[int, int], list[int]] = {}
        for i, (x, v) in enumerate(zip(leaf, vectors, strict=True)):
            together.setdefault((x, len(v)), []).append(i)
        for (x, width), own in together.items():
            number, tail = x >> 16, x & 65535
            if lower[own[0]] is None:
                for i in own:
                    out[i].append(((number << depth) << 16) + tail)
                continue
            low, high = (_by_level(side[own[0]], depth) for side in (lower, upper))
            row, node = descend(_unit([vectors[i] for i in own]) @ directions(x, width).T, low, high)
            for r, to in zip(row.tolist(), node.tolist(), strict=True):
                out[own[r]].append((((number << depth) + to) << 16) + tail)
        return pa.RecordBatch.from_arrays([part.column("node"), part.column("vector"), pa.array(out, pa.list_(pa.int64()))], ["node", "vector", "leaves"])

    python_workers(rows.sparkSession)
    bounds_of = sample.mapInArrow(fitted, "leaf long, lower array<double>, upper array<double>")
    return map_batches(rows.join(bounds_of, "leaf", "left"), place, f"node long, vector {kind}, leaves array<long>")


def _by_level(bounds: list[float], depth: int) -> list[np.ndarray]:
    """A tree's bounds, listed from the root on, as an array for each level."""
    return [np.asarray(bounds[(1 << level) - 1:(2 << level) - 1]) for level in range(depth)]


def _in_components(members: DataFrame, least: float, p: Forest) -> DataFrame:
    """(node, links): the rows linked with each member of a component, in parts to be summed.

    A large component is divided among centres drawn from its members. A member has
    its home in the cell of its nearest centre p, and is a guest in the cell of a
    later centre q if it lies near enough to the plane half way between p and q for
    a link to reach across: rows behind that plane are at least (x.p - x.q) / |p - q|
    away, and linked rows are at most sqrt(2 - 2 least) apart. So each linked pair
    meets once, as two rows at home or as a row at home and a guest. Wide
    components, such as chains, compare near cells only; a group of near copies
    compares all its pairs, as most are links.
    """
    large = members.groupBy("component").count().filter(F.col("count") > p.block)
    rows = large.agg(F.sum("count")).first()[0] or 0
    part = min(1.0 / p.block, 0.9 * p.fit_rows / max(1, rows))
    chosen = F.pmod(F.xxhash64("node", F.lit(p.seed)), F.lit(1 << 30)) < int(part * (1 << 30))
    taken = members.filter(chosen).join(large, "component", "left_semi").select("component", "node", "vector").limit(p.fit_rows)
    centres: dict[int, list] = {}
    for r in sorted(taken.collect(), key=lambda r: r.node) if rows else []:
        centres.setdefault(r.component, []).append(r.vector)
    fixed = {component: _unit(vectors) for component, vectors in centres.items()}
    shared = members.sparkSession.sparkContext.broadcast(fixed)
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9

    def place(part: pa.RecordBatch) -> pa.RecordBatch:
        of, vectors = part.column("component").to_pylist(), part.column("vector").to_pylist()
        cells = [[0]] * len(of)
        at: dict[int, list[int]] = {}
        for i, component in enumerate(of):
            if component in shared.value:
                at.setdefault(component, []).append(i)
        for component, own in at.items():
            unit = shared.value[component]
            near = _unit([vectors[i] for i in own]) @ unit.T
            home = near.argmax(axis=1)
            apart = np.sqrt(np.maximum(0, 2 - 2 * unit[home] @ unit.T))
            guest = near.max(axis=1, keepdims=True) - near <= reach * apart + 1e-9
            guest &= np.arange(len(unit)) > home[:, None]
            for i, first, more in zip(own, home.tolist(), guest, strict=True):
                cells[i] = [first, *np.flatnonzero(more).tolist()]
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, pa.list_(pa.int32()))], [*part.schema.names, "cells"])

    kind = members.schema["vector"].dataType.simpleString()
    placed = map_batches(
        members.select("component", "node", "copies", "vector"), place,
        f"component long, node long, copies long, vector {kind}, cells array<int>",
    )
    lying = placed.select("*", F.posexplode("cells").alias("place", "cell")).withColumn("home", F.col("place") == 0)
    # Cells of one block, nearly all, need no row here.
    sizes = stored(
        lying.groupBy(F.col("component").alias("s_component"), F.col("cell").alias("s_cell"))
        .agg((F.ceil(F.count_if("home") / p.block)).cast("int").alias("homes"), F.ceil(F.count_if(~F.col("home")) / p.block).cast("int").alias("guests"))
        .filter("homes > 1 or guests > 0")
    )
    homes, guests, key = F.coalesce("homes", F.lit(1)), F.coalesce("guests", F.lit(0)), F.xxhash64("node")
    sided = (
        lying.join(bounded(sizes, sizes.count()), (F.col("component") == F.col("s_component")) & (F.col("cell") == F.col("s_cell")), "left")
        .withColumns({"homes": homes, "guests": guests}).filter("homes > 0")
        .withColumn("block", F.when(F.col("home"), F.pmod(key, F.col("homes"))).otherwise(F.col("homes") + F.pmod(key, F.col("guests"))).cast("int"))
    )
    # A row at home meets all blocks of its cell, a guest those of rows at home.
    others = F.when(F.col("home"), F.col("homes") + F.col("guests")).otherwise(F.col("homes"))
    dealt = (
        sided.withColumn("meet", F.explode(_meets(others)))
        .select("component", "cell", "meet.i", "meet.j", "block", "node", "vector", "copies")
        .repartition("component", "cell", "i", "j").sortWithinPartitions("component", "cell", "i", "j")
    )

    def counted(group: list[tuple]) -> list[tuple]:
        copies, links = np.array([g[7] for g in group], float), np.zeros(len(group))
        for x, y, hit in _hits(group, 6, least):
            one = hit.astype(float)
            links[x] += one @ copies[y]
            links[y] += copies[x] @ one
        return [(g[5], int(k)) for g, k in zip(group, links.tolist(), strict=True) if k]

    return _by_group(dealt, counted, ["node", "links"])


def _meets(others: Column) -> Column:
    """The pairs (i, j) of the row's own block with each of the first ``others`` blocks."""
    block = F.col("block")
    return F.transform(
        F.sequence(F.lit(0), others - 1),
        lambda other: F.struct(F.least(other, block).alias("i"), F.greatest(other, block).alias("j")),
    )


def _by_group(dealt: DataFrame, run: Callable[[list[tuple]], list[tuple]], names: list[str]) -> DataFrame:
    """``run`` on each run of rows that are equal in the first four columns."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [() for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def stream(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for part in parts:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if held and held[0][:4] != row[:4]:
                    out += run(held) if len(held) > 1 else []
                    held = []
                held.append(row)
            yield batch(out)
        yield batch(run(held) if len(held) > 1 else [])

    python_workers(dealt.sparkSession)
    return dealt.mapInArrow(stream, ", ".join(f"{name} long" for name in names))


def _hits(group: list[tuple], vector: int, least: float, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, which of x by y are linked), over all pairs of a block, or of two blocks with i and j in columns 2 and 3."""
    i, j = group[0][2:4]
    unit = _unit([g[vector] for g in group])
    side = np.array([g[4] for g in group])
    xs = np.flatnonzero(side == i)
    for start in range(0, len(xs), rows):
        x = xs[start:start + rows]
        y = np.flatnonzero(side == j) if i != j else xs[start:]
        if not len(y):
            return
        cos = unit[x] @ unit[y].T
        hit = cos >= least
        # Products of a matrix may differ in the last bit from those of one pair.
        a, b = np.nonzero(np.abs(cos - least) < 1e-9)
        for at in range(0, len(a), 1 << 16):
            k, m = a[at:at + (1 << 16)], b[at:at + (1 << 16)]
            hit[k, m] = np.einsum("ij,ij->i", unit[x[k]], unit[y[m]]) >= least
        yield x, y, hit if i != j else np.triu(hit, 1)


def _merge(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Join the parts that x and y lie in; a label is the smallest row of its part."""
    while True:
        a, b = label[x], label[y]
        differ = a != b
        if not differ.any():
            return
        x, y, a, b = x[differ], y[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]
