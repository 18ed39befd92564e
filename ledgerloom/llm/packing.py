"""Pack documents into batches of a token budget, inside length buckets of least padding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import numbered, words

#: Lengths up to ``EXACT`` have a bin of their own; longer ones share bins of EXACT / 2 steps for
#: each doubling, so a histogram has at most about EXACT / 2 bins for each doubling.
EXACT = 1024


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The at most ``buckets`` upper lengths with the least padding in total.

    ``lengths`` rise; every row is padded to the smallest boundary that holds it. For
    each number of buckets the best end before every length is found from the best
    for one bucket fewer.
    """
    m = len(lengths)
    if not m:
        return []
    total = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    mass = np.concatenate([[0], np.cumsum(lengths * counts)]).astype(float)
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    came: list[np.ndarray] = []
    costs = []
    for _ in range(min(buckets, m)):
        new, last = np.full(m + 1, np.inf), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            cost = best[:j] - total[:j] * lengths[j - 1] + mass[:j]
            i = int(np.argmin(cost))
            new[j] = cost[i] + total[j] * lengths[j - 1] - mass[j]
            last[j] = i
        best = new
        came.append(last)
        costs.append(best[m])
    k, j, bounds = int(np.argmin(costs)), m, []
    while j > 0:
        bounds.append(int(lengths[j - 1]))
        j, k = int(came[k][j]), k - 1
    return bounds[::-1]


def histogram(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The largest length and the number of rows of every bin; the bins are bounded, not the rows.

    A bin above ``EXACT`` is at most a part 2 / EXACT of its lengths wide. Boundaries are
    largest lengths of bins, so the best ones of all lengths, each raised to the end of its
    bin, are among those that ``best_boundaries`` compares: what it chooses pads all rows
    to at most 1 + 2 / EXACT times the total of the exact optimum.
    """
    n = F.col("n_tokens")
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))) - int(np.log2(EXACT)) + 1))
    bins = rows.groupBy(F.floor(n / step).alias("at"), step.alias("step")).agg(
        F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("n")
    ).orderBy("length").collect()
    return np.array([r.length for r in bins], np.int64), np.array([r.n for r in bins], np.int64)


def pack(
    docs: DataFrame,
    budget: int,
    buckets: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
) -> DataFrame:
    """doc_id, n_tokens, bucket, padded, padding, batch and slot of every row.

    ``length`` is the size in tokens, as ``count_tokens`` gives it; without it, words
    count. The boundaries of the buckets minimise the padding over all rows: exactly for
    lengths up to ``EXACT``, beyond it within the bound stated at ``histogram``. A batch holds rows of one bucket, padded
    to its boundary, up to ``budget`` tokens in all; a row longer than the budget has a
    batch of its own. Batches count from 0 in a bucket, slots from 0 in a batch; all
    batches of a bucket but the last are full. No row is cut or left out: NULL and
    empty texts have length 0 and a place like others, as has every row that repeats
    an id. Rows of one length may take any place among each other; reruns over the same
    files agree. Columns with the names of the result do not clash: only the id, the text
    and ``length`` are read. An empty table gives an empty result.

    Scale: the histogram is combined before the shuffle and bounded; places in a bucket
    are numbered by input partition, so a bucket with most rows is in no single task.
    """
    n = words(F.col(text_col)) if length is None else F.coalesce(length, F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), n.alias("n_tokens"))
    bounds = best_boundaries(*histogram(rows), buckets)
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(0).cast("long"))
    at = F.size(F.filter(edges, lambda b: b < F.col("n_tokens")))
    placed = numbered(rows.withColumn("bucket", at.cast("int")), ["bucket"], "place")
    padded = F.element_at(edges, F.col("bucket") + 1)
    held = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(padded, F.lit(1)))).cast("long")
    return placed.select(
        "doc_id", "n_tokens", "bucket", padded.alias("padded"), (padded - F.col("n_tokens")).alias("padding"),
        F.floor(F.col("place") / held).cast("long").alias("batch"), (F.col("place") % held).alias("slot"),
    )
