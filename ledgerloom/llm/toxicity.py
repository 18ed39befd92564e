"""Toxic passages by maximum-scoring segments of token log-odds."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.common import bounded, filtered, map_batches, python_workers, stored

_TOKEN = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    """How tokens are learned and passages are found.

    Besides a token its beginnings of ``stems`` characters are features, so unseen
    endings of a known stem still count. ``prior`` is the Dirichlet weight of a
    feature in each class. Features below ``least_odds`` or ``least_z`` or in fewer
    than ``least_texts`` or ``least_share`` of the toxic texts are left out, and at most ``features`` are kept,
    strongest first: that bounds the model. Any other token costs ``drift``. Of more
    than ``label_rows`` labels a seeded part of about that many is learned from.
    """

    stems: tuple[int, ...] = (4, 5, 6)
    prior: float = 0.5
    least_odds: float = 3.5
    least_z: float = 2.5
    least_texts: int = 3
    least_share: float = 0.002
    features: int = 50_000
    drift: float = 0.7
    label_rows: int = 150_000


@dataclass(frozen=True)
class Model:
    """Scores of features, the scale and rate of chance passages, and the curve over ln(1 + surprise)."""

    scores: dict[str, float]
    settings: Settings
    scale: float = 1.0
    rate: float = 1.0
    slope: float = 0.0
    offset: float = 0.0


def training(id_: Column) -> Column:
    """Whether labels of a row may be learned; the rest is held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def features(token: str, s: Settings) -> Iterator[str]:
    yield token
    for n in s.stems:
        if len(token) > n:
            yield f"{token[:n]}*"


class TokenScores(dict):
    """Token to score: its own log-odds, else that of its longest known beginning, else minus the drift."""

    def __init__(self, model: Model):
        super().__init__(model.scores)
        self.known, self.drift = model.scores, -model.settings.drift
        self.stems = sorted(model.settings.stems, reverse=True)

    def __missing__(self, token: str) -> float:
        found = (self.known.get(f"{token[:n]}*") for n in self.stems if len(token) > n)
        value = self[token] = next((x for x in found if x is not None), self.drift)
        return value


def segments(values: np.ndarray) -> list[tuple[float, int, int]]:
    """Every maximal-scoring segment (score, start, end), in one pass over the values.

    Each positive value opens a segment, remembered with the sums before and after
    it. It is merged with an earlier one if the sum before that one is lower and the
    sum after it is lower too.
    """
    sums = np.concatenate([[0.0], np.cumsum(values)])
    held: list[tuple[float, float, int, int]] = []
    for at in np.flatnonzero(values > 0).tolist():
        left, right, start = float(sums[at]), float(sums[at + 1]), at
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][0] >= left:
                k -= 1
            if k < 0 or held[k][1] >= right:
                break
            left, start = held[k][0], held[k][2]
            del held[k:]
        held.append((left, right, start, at + 1))
    return [(right - left, start, end) for left, right, start, end in held]


def passages(text: str, known: TokenScores) -> tuple[int, list[tuple[float, int, int]]]:
    """The number of tokens and the maximal segments, in tokens."""
    words = tokens(text)
    return len(words), segments(np.fromiter(map(known.__getitem__, words), float, len(words)))


def surprise(n: int, scores: list[float], model: Model) -> float:
    """-ln of the chance that clean text of ``n`` tokens holds such segments; 0 without any.

    Chance segments follow an extreme-value law: about rate * n * exp(-scale * S) reach
    the score S. For the r best together the sum of scale * S - ln(rate * n) counts,
    and the most surprising r is taken.
    """
    if not scores:
        return 0.0
    normal = model.scale * np.sort(np.asarray(scores))[::-1] - np.log(max(model.rate * n, 1e-12))
    sums = np.cumsum(normal)
    r = np.arange(1, len(sums) + 1)
    logs = np.cumsum(np.log(r))
    # exp(-s) * s ** (r - 1) / (r! (r - 1)!), and 1 - exp(-exp(-s)) for one segment.
    chance = sums - (r - 1) * np.log(np.maximum(sums, 1.0)) + logs + (logs - np.log(r))
    chance[0] = -np.log(-np.expm1(-np.exp(-sums[0]))) if sums[0] < 30 else sums[0]
    return float(max(0.0, chance.max()))


def _counts(rows: DataFrame, s: Settings) -> DataFrame:
    """(feature, texts and occurrences in each class) of the labelled rows; an empty feature has the totals."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter(), Counter(), Counter(), Counter()]

        def flush() -> pa.RecordBatch:
            names = list(set().union(*seen))
            arrays = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in seen)]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(arrays, ["feature", "texts0", "texts1", "uses0", "uses1"])

        for part in parts:
            for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                words = tokens(text)
                uses = Counter()
                for word, n in Counter(words).items():
                    for feature in features(word, s):
                        uses[feature] += n
                seen[label].update(uses.keys())
                seen[2 + label].update(uses)
                seen[label][""] += 1
                seen[2 + label][""] += len(words)
            if sum(map(len, seen)) > 1_000_000:
                yield flush()
        yield flush()

    python_workers(rows.sparkSession)
    found = rows.mapInArrow(count, "feature string, texts0 long, texts1 long, uses0 long, uses1 long")
    return found.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("texts0", "texts1", "uses0", "uses1")])


def _learn(rows: DataFrame, s: Settings) -> tuple[dict[str, float], list[float], float]:
    """Scores of the kept features, their rates of use in clean text, and the clean tokens."""
    counts = stored(_counts(rows, s).filter((F.col("feature") == "") | (F.col("texts1") >= s.least_texts)))
    totals = counts.filter("feature = ''").first()
    if totals is None or not totals.texts0 or not totals.texts1:
        return {}, [], 0.0
    n0, n1, a = totals.texts0, totals.texts1, s.prior
    hit1, hit0 = F.col("texts1") + a, F.col("texts0") + a
    odds = F.log(hit1 / (n1 + 2 * a - hit1)) - F.log(hit0 / (n0 + 2 * a - hit0))
    z = odds / F.sqrt(1 / hit1 + 1 / hit0)
    kept = (
        counts.filter(F.col("feature") != "").filter(
            (F.col("texts1") >= max(s.least_texts, s.least_share * n1)) & (odds >= s.least_odds) & (z >= s.least_z)
        )
        .select("feature", odds.alias("score"), "uses0", z.alias("z"))
        .orderBy(F.desc("z"), "feature").limit(s.features).collect()
    )
    scores = {r.feature: r.score for r in kept}
    rates = [(r.uses0 + a) / max(1, totals.uses0) for r in kept]
    return scores, rates, float(totals.uses0)


def _scale(scores: list[float], rates: list[float], drift: float) -> float:
    """The positive root of: mean of exp(scale * score) over clean tokens = 1."""
    x, p = np.asarray(scores), np.asarray(rates)
    rest = max(0.0, 1 - p.sum())

    def mean(scale: float) -> float:
        return float((p * np.exp(np.minimum(700, scale * x))).sum() + rest * np.exp(-scale * drift))

    low, high = 0.0, 1.0
    while mean(high) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(0.05, (low + high) / 2)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(toxic) by x, fitted with smoothed targets and a light penalty."""
    ones, zeros = weight[y == 1].sum(), weight[y == 0].sum()
    goal = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    design = np.stack([x, np.ones_like(x)], 1)

    def loss(beta: np.ndarray) -> float:
        t = design @ beta
        return float((weight * (np.logaddexp(0, t) - goal * t)).sum() + 5e-4 * beta[0] ** 2)

    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (goal - p)) - np.array([1e-3, 0]) * beta
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(bend, slope)
        while loss(beta + step) > loss(beta) and np.abs(step).max() > 1e-12:
            step /= 2
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn token scores, the extreme-value law and the final curve from the labelled rows for training.

    Rows with a NULL id, label or text teach nothing; of equal texts with equal
    labels one does. Without both classes the model finds nothing: every score is
    the same.

    The labels learned from are bounded, so they are sent to the documents, whose
    texts are never shuffled.
    """
    known = labels.select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & training(F.col("l_id"))
    ).distinct()
    n = known.count()
    if n > settings.label_rows:
        part = int((1 << 30) * settings.label_rows / n)
        known = known.filter(F.pmod(F.xxhash64("l_id", F.lit(29)), F.lit(1 << 30)) < part)
    text_of = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("text is not null")
    text_of = text_of.filter(training(F.col("doc_id")))

    def with_labels(labelled: DataFrame) -> DataFrame:
        return text_of.join(bounded(labelled, min(n, settings.label_rows)), F.col("doc_id") == F.col("l_id"))

    first = with_labels(known).groupBy(F.xxhash64("text"), "toxic").agg(F.min("doc_id").alias("l_id")).select("l_id", "toxic")
    rows = with_labels(stored(first.distinct())).select("text", "toxic")
    scores, rates, clean_tokens = _learn(rows, settings)
    model = Model(scores, settings)
    if not scores:
        return model
    scale = _scale(list(scores.values()), rates, settings.drift)

    def cut(part: pa.RecordBatch) -> pa.RecordBatch:
        known = TokenScores(model)
        found = [passages(text, known) for text in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("toxic"), pa.array([n for n, _ in found], pa.int64()), pa.array([[x[0] for x in xs] for _, xs in found], pa.list_(pa.float64()))],
            ["toxic", "n", "scores"],
        )

    found = stored(map_batches(rows, cut, "toxic int, n long, scores array<double>"))
    least = min(scores.values())
    chance = found.filter("toxic = 0").agg(F.sum(F.size(F.filter("scores", lambda x: x >= least)))).first()[0] or 0
    model = Model(scores, settings, scale, (chance + 0.5) / (max(1.0, clean_tokens) * float(np.exp(-scale * least))))

    def surprises(part: pa.RecordBatch) -> pa.RecordBatch:
        # In steps of 1/4, at most 200: a bounded table whatever the rows.
        x = [min(200.0, round(4 * surprise(n, s, model)) / 4) for n, s in zip(part.column("n").to_pylist(), part.column("scores").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(x, pa.float64())], ["toxic", "x"])

    table = map_batches(found, surprises, "toxic int, x double").groupBy("toxic", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    x, y, n = (np.array([r[c] for r in table], float) for c in ("x", "toxic", "n"))
    slope, offset = _logistic(np.log1p(x), y, n)
    return Model(scores, settings, scale, model.rate, slope, offset)


def _judged(texts: list[str | None], model: Model) -> list[tuple[float, int, list[dict]]]:
    """Score, tokens and significant passages of each text."""
    known = TokenScores(model)
    out = []
    for text in texts:
        n, found = passages(text or "", known)
        x = min(200.0, surprise(n, [s[0] for s in found], model))
        value = 1 / (1 + float(np.exp(-np.clip(model.slope * np.log1p(x) + model.offset, -30, 30))))
        rare = [{"score": s, "start": a, "end": b} for s, a, b in found if model.rate * n * np.exp(-model.scale * s) < 0.01]
        out.append((value, n, rare))
    return out


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return filtered(docs, text_col, lambda texts: [x < threshold for x, _, _ in _judged(texts, shared.value)])


def score(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the passages of every row.

    A passage is a maximal segment that clean text of this length would hold by chance
    less than once in a hundred; start and end count tokens. The score is between 0
    and 1, higher when toxic is likelier; NULL and empty texts get the score of a text
    without any passage. Rows that repeat an id are scored each; held_out is true for a
    NULL id. Whole texts are scored, a row at a time: no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        found = _judged(part.column("text").to_pylist(), shared.value)
        values, counts, spans = zip(*found, strict=True) if found else ((), (), ())
        kind = pa.list_(pa.struct([("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(values, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, kind)],
            ["doc_id", "score", "n_tokens", "passages"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = map_batches(rows, judge, "doc_id long, score double, n_tokens long, passages array<struct<score:double,start:int,end:int>>")
    return scored.select(
        "doc_id", (~training(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "n_tokens", "passages",
    )
