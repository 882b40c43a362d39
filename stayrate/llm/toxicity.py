"""Toxicity: cumulative-link ordinal regression on sparse text features.

Grades 0..K are ordered; P(grade > k) = sigmoid(w.x - t_k), with one weight
vector for all thresholds t_0 < t_1 < ...  The expected severity is the sum of
these probabilities.  Features are the presence of hashed words and
word beginnings, so one word weighs the same in a short and in a long text.

The model is fitted on a bounded sample of labelled documents (``TRAIN_ROWS``)
in one task: features are screened for those that toxic rows use far more
often, then weighted by adaptive proximal gradient steps with an L1 penalty.
Every document is scored.  Labels that only say toxic or not are graded first
(``grade_binary``): the grade of a toxic training row is its third (of all
toxic ones) by the number of its screened features.

Defined results: a null or empty text has the severity of the thresholds
alone; a null id is never a training row; without training rows severity is 0;
repeated rows are documents of their own; columns other than the text are no
inputs; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stayrate.llm import features, spans
from stayrate.llm.store import materialize, ship, task

TRAIN_ROWS = 10_000
EPOCHS = 5
GRADES = 3
ALPHA, BETA, L1 = 0.3, 1.0, 1.0
#: A feature is used from this ratio of document frequencies (toxic to other) on, in at least so many rows.
SCREEN_RATIO, SCREEN_ROWS = 8.0, 3
#: A document is called toxic from this probability of a grade above 0 on.
TOXIC = 0.2


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def screen(toxic: np.ndarray, index: list[np.ndarray]) -> np.ndarray:
    """Which features toxic rows use far more often than others."""
    df = [np.zeros(features.DIMS), np.zeros(features.DIMS)]
    for t, i in zip(toxic.tolist(), index):
        df[int(t)][i] += 1
    n = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    return (df[1] >= SCREEN_ROWS) & ((df[1] + 0.5) / n[0] >= SCREEN_RATIO * (df[0] + 0.5) / n[1])


def grade_binary(toxic: np.ndarray, index: list[np.ndarray], grades: int = GRADES) -> np.ndarray:
    """Grades 0..grades of rows with their screened features."""
    out = np.zeros(len(toxic), np.int64)
    count = np.array([len(i) for i in index])
    if toxic.any():
        edges = np.quantile(count[toxic], np.arange(1, grades) / grades)
        out[toxic] = 1 + np.searchsorted(edges, count[toxic], "right")
    return out


def fit_ordinal(grade: np.ndarray, index: list[np.ndarray], x: list[np.ndarray], grades: int,
                epochs: int = EPOCHS) -> OrdinalModel:
    """Adaptive proximal steps on the cumulative-link likelihood, row after row.

    The gradient of a row by its score s = w.x is the sum over its one or two
    neighbouring thresholds; thresholds start at the grades' log odds and are
    kept in order.
    """
    z, n = np.zeros(features.DIMS), np.zeros(features.DIMS)
    above = np.array([(np.sum(grade > k) + 0.5) / (len(grade) + 1) for k in range(grades)])
    t = -np.log(above / (1 - above))
    t_n = np.ones(grades)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA))

    for _ in range(epochs):
        for y, i, v in zip(grade.tolist(), index, x):
            w = weights(i)
            up = _sigmoid(w @ v - t)  # P(grade > k)
            # P(grade = y) = up[y - 1] - up[y], with 1 before and 0 after the ends
            hi = up[y - 1] if y > 0 else 1.0
            lo = up[y] if y < grades else 0.0
            p = max(hi - lo, 1e-9)
            d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
            g = float(np.clip(d_lo - d_hi, -1, 1)) * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
            for k, d in ((y - 1, d_hi), (y, -d_lo)):
                if 0 <= k < grades:
                    d = float(np.clip(d, -1, 1))
                    t_n[k] += d * d
                    t[k] -= 0.1 * d / np.sqrt(t_n[k])
            np.maximum.accumulate(t, out=t)
    return OrdinalModel(weights(np.arange(features.DIMS)), t)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", grades: int = GRADES,
        binary: bool = True, bound: int = TRAIN_ROWS) -> OrdinalModel:
    """Train on at most ``bound`` documents labelled 0 or 1 (``binary``) or with grades 0..grades."""
    rows = features.training_rows(docs, labels, label_col, bound, features.word_presence)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, index, x = features.read_training(batches)
        if len(y):
            used = screen(y > 0, index)
            x = [v[used[i]] for v, i in zip(x, index)]
            index = [i[used[i]] for i in index]
            grade = grade_binary(y > 0, index, grades) if binary else np.clip(y, 0, grades).astype(np.int64)
            m = fit_ordinal(grade, index, x, grades)
            some = np.flatnonzero(m.weights).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (
                some, m.weights[some], m.thresholds)], names=["index", "weight", "thresholds"])

    weights = np.zeros(features.DIMS)
    made = materialize(rows.mapInArrow(task(train), "index binary, weight binary, thresholds binary"), "ordinal")
    for r in made.collect():  # one row, of at most DIMS weights
        weights[np.frombuffer(r["index"], np.int32)] = np.frombuffer(r["weight"])
        return OrdinalModel(weights, np.frombuffer(r["thresholds"]).copy())
    return OrdinalModel(weights, np.full(grades, np.inf))


def severity(docs: DataFrame, model: OrdinalModel, carry: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the carried columns), ``severity`` (expected grade) and
    ``p_toxic`` (P(grade > 0)) of every document."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, t = held.value
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(1))
            up = _sigmoid(features.dots(data, offs, features.word_presence, weights)[:, None] - t[None, :])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(up.sum(axis=1)), pa.array(up[:, 0])],
                                             names=["row", "severity", "p_toxic"])

    return rows.mapInArrow(task(run), StructType([rows.schema["row"], StructField("severity", DoubleType()),
                                            StructField("p_toxic", DoubleType())]))
