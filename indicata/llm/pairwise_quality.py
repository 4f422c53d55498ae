"""Operator 3, quality classifier: Bradley-Terry pairwise ranking.

From labelled documents, preference pairs (one of label 1, one of label 0) are
drawn; a linear score is learned by logistic loss on the difference of the two
documents' features.  The fit is on a bounded sample.  The threshold is the
quantile of the scores of all labelled training rows at the share of label 0,
and the reported score is a logistic curve that takes the value 0.3 there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.llm.common import id_text, stage

#: Bounds of the fit: labelled rows, preference pairs.
SAMPLE_ROWS, PAIRS = 20_000, 200_000
CUT = 0.3
#: Intervals of a step of the quantile search.
INTERVALS = 4096

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_COUNTED = [b"#*$%&<>", b"|", b"!?", b".", b",", b"0123456789", b"{}[]()=;:/\\_\"'+-@~^`"]
FEATURES = ["length", "word_length", "symbols", "bars", "shouts", "stops", "commas", "digits",
            "marks", "upper", "distinct", "echo", "line_words", "dup_lines", "longest"]


def _count(data: bytes, which: bytes) -> int:
    return len(data) - len(data.translate(None, which))


def features(text: str | None) -> list[float]:
    """Numbers about the form of a text; all of them 0 for an empty one."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    size = sum(map(len, words))
    counted = [math.log1p(10 * _count(data, c) / n) for c in _COUNTED]
    letters = _count(data, _LETTERS)
    lines = [x for x in data.split(b"\n") if x.strip()]
    echo = sum(map(bytes.__eq__, words, words[1:])) / n
    return [math.log1p(n), size / n, *counted, _count(data, _UPPER) / max(1, letters),
            math.log1p(len(set(words))) / math.log1p(n), echo, math.log1p(n / len(lines)),
            1 - len(set(lines)) / len(lines), math.log1p(max(map(len, words)))]


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        s = self.raw(x) - self.threshold
        return 1 / (1 + np.exp(-np.clip(s + math.log(CUT / (1 - CUT)), -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 11, steps: int = 400,
        ridge: float = 1e-3) -> Model | None:
    """Bradley-Terry by gradient descent with momentum; None unless both labels occur."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return None
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    z = (x - mean) / spread
    rng = np.random.default_rng(seed)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))
        speed = 0.9 * speed + 0.2 * (diff.T @ wrong / pairs - ridge * w)
        w = w + speed
    s = np.sort(z @ w)
    k = len(bad)  # the quantile at the share of label 0, between two scores
    return Model(mean, spread, w, float((s[k - 1] + s[min(k, len(s) - 1)]) / 2))


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_text(id_col)), F.lit(5)) == 0


def smallest(scores: DataFrame, k: int) -> float:
    """The ``k``-th smallest (from 1) of the column ``s``, which must be finite.

    Counts by interval, then by interval of the one that has it, until that
    one holds a single value: exact, with INTERVALS rows at the driver.
    """
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    while low < high:
        step = (high - low) / INTERVALS
        place = F.floor((F.col("s") - low) / step) if step else F.col("s") > low
        rows = (scores.filter(F.col("s").between(low, high)).groupBy(place.alias("i"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("a"), F.max("s").alias("b"))
                .orderBy("i").collect())
        for r in rows:
            if k <= r.n:
                break
            k -= r.n
        low, high = r.a, r.b
    return low


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model | None:
    """A model fitted to at most about SAMPLE_ROWS labelled rows outside the held-out fold,
    with the threshold of all of these rows."""
    known = labels.filter(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col))) \
        .select(id_col, label_col)
    n = known.count()
    draw = F.pmod(F.xxhash64(id_text(F.col(id_col)), F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    picked = F.broadcast(known.filter(draw < SAMPLE_ROWS / max(1, n)))  # bounded by SAMPLE_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    got = docs.select(id_col, text_col).join(picked, id_col).select(
        text_col, F.col(label_col).cast("int")).mapInArrow(run, "x array<double>, y int") \
        .toPandas()
    if got.empty:
        return None
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy()
    order = np.lexsort(x.T)
    model = fit(x[order], y[order])
    if model is None:
        return None

    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t.as_py()) for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.raw(rows.reshape(-1, len(FEATURES))),
                                           pa.float64())], ["id", "s"])

    # Scored before the join, so that it moves numbers and no texts.
    every = docs.select(id_col, text_col).filter(~held_out(F.col(id_col))) \
        .mapInArrow(score, f"id {kind}, s double")
    scores = stage(every.join(known.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")),
                              "id").select("s", "y"), "scores")
    total, bad = scores.agg(F.count(F.lit(1)), F.sum(F.when(F.col("y") == 0, 1).otherwise(0))) \
        .first()
    # The quantile at the share of label 0, between two scores.
    return replace(model, threshold=(smallest(scores, bad)
                                     + smallest(scores, min(bad + 1, total))) / 2)


def rank(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The id and the score (0 to 1, higher: better) of every row.

    A null text counts as empty, and an empty text is scored as any other.
    Without a model (no labelled row, or one label only) every score is 0.5.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)]) \
                .reshape(-1, len(FEATURES))
            s = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())],
                                             [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
