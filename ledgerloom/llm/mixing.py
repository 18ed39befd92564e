"""Mix sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm.common import bounded, seeded_key, stored, words

#: Hexadecimal digits of the key that make a cell; one cell of a source is ordered.
CELL_DIGITS = 3


def water_level(sources: DataFrame, total: float) -> tuple[float, float]:
    """The level at which the sources share ``total`` words, and the weight still free there.

    ``sources`` has ``cap`` and ``weight``. A source takes ``level * weight`` words
    or its cap. Each pass clamps the sources above their cap and shares out what is
    left by weight; the level only rises, so passes end when no source is newly
    clamped. Only sums reach the driver.
    """
    level = 0.0
    free = F.col("cap") > F.lit(level) * F.col("weight")
    while True:
        clamped, weight = sources.agg(
            F.coalesce(F.sum(F.when(free, 0.0).otherwise(F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(free, F.col("weight"))), F.lit(0.0)),
        ).first()
        if weight <= 0:
            return level, 0.0
        new = max(0.0, total - clamped) / weight
        if new <= level:
            return level, weight
        level = new
        free = F.col("cap") > F.lit(level) * F.col("weight")


def mix(
    docs: DataFrame,
    weights: DataFrame,
    share: float,
    max_epochs: float,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size: Column | None = None,
    carry: bool = False,
) -> DataFrame:
    """How many words of each document a mix takes.

    The sources of ``weights`` (source, weight > 0; NULL is a source) share
    ``share`` times all words by weight. No source is read more than
    ``max_epochs`` times: a larger share is clamped and the excess shared again by
    weight until all fit. A source read 1.4 times takes each document once, and
    again the documents at the front of a seeded shuffle until 0.4 of its words are
    reached; the document at that edge is taken in part, so a source meets its
    target to the word.

    Returns doc_id, source, size, source_size, target, repeats (whole readings), extra
    (words of the fractional one) and taken = repeats * size + extra; with ``carry``
    also ``row``, all columns of the document, whose text is then read twice. Documents
    without words, and sources without any or without a weight, take nothing. A row
    that repeats an id counts as a document of its own. An empty table gives an
    empty result.

    Scale: texts are read once. A source is cut into 4096 cells by its shuffle key;
    sums for each cell show which one holds the edge, and that cell alone is put
    in order, so a source with a third of all rows needs no large task.
    """
    described = docs.select(
        *([F.struct("*").alias("row")] if carry else []),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (words(F.col(text_col)) if size is None else size.cast("long")).alias("size"),
        seeded_key(seed, F.col(id_col), F.col(text_col)).alias("key"),
    ).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    base = stored(described.drop("row"))
    cells = stored(base.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")))
    sums = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")).alias("s")
    known = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double").alias("weight"))
    sources = stored(
        sums.join(known, F.col("s.source").eqNullSafe(F.col("w_source")), "left")
        .select("s.source", "source_size", F.coalesce("weight", F.lit(0.0)).alias("weight"))
        .withColumn("cap", F.when(F.col("weight") > 0, F.col("source_size") * F.lit(float(max_epochs))).otherwise(0.0))
    )
    rows, all_words = sources.agg(F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    level, free = water_level(sources, share * all_words)
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight")) if free > 0 else F.col("cap")
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = (
        sources.withColumn("target", target)
        .withColumn("repeats", repeats.cast("long"))
        .withColumn("need", F.floor(F.col("target") - F.col("repeats") * F.col("source_size") + 0.5).cast("long"))
        .alias("p")
    )
    # The cell in which the words still needed end, and how many end there.
    along = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    before = (F.sum("cell_size").over(along) - F.col("cell_size")).alias("before")
    edges = (
        cells.select("source", "cell", "cell_size", before).alias("c")
        .join(
            plan,
            F.col("c.source").eqNullSafe(F.col("p.source"))
            & (F.col("before") < F.col("need"))
            & (F.col("before") + F.col("cell_size") >= F.col("need")),
        )
        .select(F.col("c.source").alias("e_source"), F.col("cell").alias("edge"), (F.col("need") - F.col("before")).alias("edge_need"))
    )
    plan = stored(
        plan.join(edges, F.col("p.source").eqNullSafe(F.col("e_source")), "left")
        .select(F.col("p.source").alias("p_source"), "source_size", "target", "repeats", "edge", "edge_need")
    )
    joined = (described if carry else base).join(bounded(plan, rows), F.col("source").eqNullSafe(F.col("p_source")))
    at_edge = F.coalesce(F.col("cell") == F.col("edge"), F.lit(False))
    whole = F.when(F.col("cell") < F.col("edge"), F.col("size")).otherwise(0)
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("edge_need") - (F.sum("size").over(order) - F.col("size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    columns = [*(["row"] if carry else []), "doc_id", "source", "size", "source_size", "target", "repeats"]
    result = joined.filter(~at_edge).select(*columns, whole.cast("long").alias("extra")).unionByName(
        joined.filter(at_edge).select(*columns, part.cast("long").alias("extra"))
    )
    return result.withColumn("taken", F.col("repeats") * F.col("size") + F.col("extra"))


def mixed_documents(docs: DataFrame, weights: DataFrame, share: float, max_epochs: float, seed: int = 17, **columns: str) -> DataFrame:
    """The documents of the mix with their own columns: a row for each reading.

    The document at the edge of a source's target is read again if at least half of
    its words are still needed; texts stay whole.
    """
    mix_ = mix(docs, weights, share, max_epochs, seed, carry=True, **columns)
    again = ((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size"))).cast("long")
    readings = (F.col("repeats") + again).alias("readings")
    read = mix_.select("row", readings).filter("readings > 0")
    return read.select("row", F.explode(F.sequence(F.lit(1), F.col("readings")))).select("row.*")
