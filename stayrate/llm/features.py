"""Hashed sparse features of whole texts, a batch at a time (numpy).

A text's features are (index, weight) pairs below ``DIMS``.  Indices come from
64-bit hashes of words and word pairs; nothing is fitted and no vocabulary is
kept, so any text of any length gets its features in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.store import ship, task

BITS = 20
DIMS = 1 << BITS

_UPPER = spans.byte_set(range(0x41, 0x5B))
_LETTER = spans.byte_set(range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), range(0x80, 0x100))
_NOT_LETTER = ~_LETTER
#: Shape of a byte: letters by case, digits alike, other bytes as they are.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x30:0x3A], _SHAPE[0x80:] = 0x41, 0x61, 0x30, 0x61

#: (text of each feature, index, weight), sorted by text.
Features = tuple[np.ndarray, np.ndarray, np.ndarray]


def _lower(data: np.ndarray) -> np.ndarray:
    return data + (_UPPER[data].astype(np.uint8) << 5)


def _pairs(a: np.ndarray, text: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbours within a text."""
    if len(a) < 2:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = spans.mix64(a[:-1] * np.uint64(0xD6E8FEB86659FD93) + a[1:] + np.uint64(salt))
    same = text[1:] == text[:-1]
    return h[same], text[1:][same]


def _collect(h: np.ndarray, text: np.ndarray, block: int, blocks: int) -> tuple[np.ndarray, ...]:
    """(text, index, count) of hashed occurrences; each block has its own range of indices."""
    size = DIMS // blocks
    key = (text.astype(np.uint64) << np.uint64(BITS)) | (h % np.uint64(size) + np.uint64(block * size))
    key, count = np.unique(key, return_counts=True)
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64(DIMS - 1)).astype(np.int64), count


def _sorted(parts: list[Features]) -> Features:
    text, index, x = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(text, kind="stable")
    return text[order], index[order], x[order]


def quality_features(data: np.ndarray, offs: np.ndarray) -> Features:
    """Words, word pairs, and pairs of word shapes (with a mark for a repeated word).

    The weight is the root of the feature's share of its kind in the text, so
    each kind has norm 1 whatever the text's length.
    """
    n = len(offs) - 1
    starts, ends, text = spans.word_spans(data, offs)
    if not len(starts):
        e = np.empty(0, np.int64)
        return e, e, np.empty(0)
    low = _lower(data)
    h = spans.span_hashes(low, starts, ends)
    # Runs of one shape are one byte.
    shape = _SHAPE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    s = spans.span_hashes(shape[keep], at[starts], at[ends])
    s[1:] += (h[1:] == h[:-1]).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    parts = []
    for k, (x, t) in enumerate([(h, text), _pairs(h, text, 1), _pairs(s, text, 2), (s, text)]):
        t, index, count = _collect(x, t, k, 4)
        total = np.bincount(t, count, n)
        parts.append((t, index, np.sqrt(count / total[t])))
    return _sorted(parts)


def word_presence(data: np.ndarray, offs: np.ndarray) -> Features:
    """Different lower-cased words (letters and digits) of a text and their first 4 and 5
    bytes, weight 1 each."""
    data = _lower(data)
    starts, ends, text = spans.word_spans(data, offs, _NOT_LETTER)
    if not len(starts):
        e = np.empty(0, np.int64)
        return e, e, np.empty(0)
    h = spans.span_hashes(data, starts, ends)
    kinds = [(h, text)]
    for n in (4, 5):
        long = ends - starts > n
        kinds.append((spans.span_hashes(data, starts[long], starts[long] + n) + np.uint64(n), text[long]))
    parts = []
    for k, (x, t) in enumerate(kinds):
        t, index, _ = _collect(x, t, k, len(kinds))
        parts.append((t, index, np.ones(len(t))))
    return _sorted(parts)


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, bound: int, features: Callable,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Features of at most ``bound`` labelled documents, in one partition, in a hashed order.

    (label, index, weight): the latter as binary int32 and float32.  Null ids
    or labels are no training rows; labels given more than once count once, by
    their largest value, and documents that share an id by their least features.
    """
    ship(docs.sparkSession)
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(bound))
    # `bound` rows of two numbers: broadcast, so no text is shuffled.
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(known), "id").select("id", "label", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = spans.text_buffer(batch.column("text"))
            for lo, hi in spans.chunks(offs):
                text, index, x = features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                cut = np.searchsorted(text, np.arange(hi - lo + 1))
                index, x = index.astype(np.int32), x.astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo),
                     *(pa.array([v[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()) for v in (index, x))],
                    names=["id", "label", "index", "weight"])

    made = rows.mapInArrow(task(run), "id long, label double, index binary, weight binary")
    # Rows that share an id count once, added up by task first: `bound` rows at most go on.
    made = (made.groupBy("id", "label").agg(F.min(F.struct("index", "weight")).alias("one"))
            .select("id", "label", "one.index", "one.weight"))
    order = F.xxhash64("id")
    return made.repartition(1).sortWithinPartitions(order, "id").select("label", "index", "weight")


def read_training(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Labels, indices and weights of the training rows, in a task."""
    y, index, x = [], [], []
    for b in batches:
        y += b.column("label").to_pylist()
        index += [np.frombuffer(v, np.int32) for v in b.column("index").to_pylist()]
        x += [np.frombuffer(v, np.float32) for v in b.column("weight").to_pylist()]
    return np.array(y), index, x


def dots(data: np.ndarray, offs: np.ndarray, features: Callable, weights: np.ndarray) -> np.ndarray:
    """The sparse dot product of every text's features with a weight vector."""
    out = np.zeros(len(offs) - 1)
    for lo, hi in spans.chunks(offs):
        text, index, x = features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
        out[lo:hi] = np.bincount(text, weights[index] * x, hi - lo)
    return out
