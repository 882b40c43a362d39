"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

It is fitted on a bounded sample of labelled documents (``TRAIN_ROWS``, in a
hashed order) by one task that sees one row after the other, as the updates
ask for; every document is scored.  The model is a vector of ``features.DIMS``
weights, the size of what is broadcast whatever the data.

Defined results: a null or empty text is scored by the bias alone; a null id
is never a training row; without training rows every score is 0.5; repeated
rows are documents of their own; columns other than the text are no inputs of
a score; an empty table gives an empty result.
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

TRAIN_ROWS = 8_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.5


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    bias: float


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def ftrl(y: np.ndarray, index: list[np.ndarray], x: list[np.ndarray], epochs: int = EPOCHS,
         alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, float]:
    """(weights, bias) after per-coordinate FTRL-proximal steps through the rows, in order.

    The bias is a coordinate like the others, without L1.
    """
    z, n = np.zeros(features.DIMS + 1), np.zeros(features.DIMS + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    def bias() -> float:
        return -z[-1] / ((beta + np.sqrt(n[-1])) / alpha)

    for _ in range(epochs):
        for target, i, v in zip(y.tolist(), index, x):
            w = weights(i)
            g0 = float(_sigmoid(w @ v + bias())) - target
            g = g0 * v
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
            z[-1] += g0 - (np.sqrt(n[-1] + g0 * g0) - np.sqrt(n[-1])) / alpha * bias()
            n[-1] += g0 * g0
    return weights(np.arange(features.DIMS)), float(bias())


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", bound: int = TRAIN_ROWS) -> Classifier:
    """Train on at most ``bound`` labelled documents."""
    rows = features.training_rows(docs, labels, label_col, bound, features.quality_features)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, index, x = features.read_training(batches)
        if len(y):
            w, bias = ftrl(y, index, x)
            some = np.flatnonzero(w).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([some.tobytes()], pa.binary()),
                                              pa.array([w[some].tobytes()], pa.binary()), pa.array([bias])],
                                             names=["index", "weight", "bias"])

    weights = np.zeros(features.DIMS)
    made = materialize(rows.mapInArrow(task(train), "index binary, weight binary, bias double"), "classifier")
    for r in made.collect():  # one row, of at most DIMS weights
        weights[np.frombuffer(r["index"], np.int32)] = np.frombuffer(r["weight"])
        return Classifier(weights, r["bias"])
    return Classifier(weights, 0.0)


def score(docs: DataFrame, model: Classifier, carry: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the carried columns) and ``score`` of every document."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = held.value
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(1))
            s = _sigmoid(features.dots(data, offs, features.quality_features, weights) + bias)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["row", "score"])

    return rows.mapInArrow(task(run), StructType([rows.schema["row"], StructField("score", DoubleType())]))


def held_out(id_col: str, folds: int = 5) -> F.Column:
    """Whether a document is in the held-out fold: crc32 of its id as text, modulo the folds."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return labels.where(~held_out(id_col))
