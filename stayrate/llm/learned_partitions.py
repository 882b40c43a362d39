"""Approximate nearest neighbours with learned partitions.

A bounded sample's exact neighbour graph is cut into equal parts with few edges between
them, by halving it again and again: each half starts from the median of the main
direction and is refined by swapping pairs of vectors that have more neighbours on the
other side.  A small network then learns, from a vector alone, in which parts its
neighbours lie.  Every vector is indexed in its most probable part; a query goes to its
most probable parts until they hold a share of the probability, and the vectors there
are ranked by exact distance.  The share is the smallest with which sample vectors that
neither the graph nor the network has seen find ``recall`` of their neighbours.

Parts are balanced on the sample; one that gets more than others is cut into blocks by
``cells``.  Of equal vectors only as many as can be wanted are indexed, and equal
queries are one.

Defined results: rows with a null id and null, empty, zero or non-finite vectors take no
part; rows equal in id and vector count once; rows of one id and different vectors are
rows of their own; vectors of different lengths never meet; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm import cells
from stayrate.llm.store import materialize, ship, task

#: Vectors that graph and network are fitted on, about; one in ``HELD_OUT`` only sets the share.
SAMPLE = 16_384
HELD_OUT = 8
#: Neighbours of a vector in the graph; vectors of a part that their number aims at, and parts at most.
EDGES = 10
PART_ROWS = 512
MAX_PARTS = 256
#: Sample vectors of a part at least.
PART_SAMPLE = 32
HIDDEN, EPOCHS, RATE, BATCH = 128, 20, 3e-3, 256


def nearest_ids(x: np.ndarray, y: np.ndarray, k: int, itself: bool) -> np.ndarray:
    """Indexes of the k nearest rows of y for each row of x (``itself``: x is y, without the row)."""
    k = min(k, len(y) - itself)
    half = (y * y).sum(axis=1) / 2
    out = np.empty((len(x), max(k, 0)), np.int64)
    for lo in range(0, len(x), 512):
        s = x[lo:lo + 512] @ y.T - half
        if itself:
            s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        if k > 0:
            out[lo:lo + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """A part of 0 .. parts - 1 (a power of two) for each row of a neighbour graph, of equal sizes."""
    part = np.zeros(len(x), np.int64)
    src, dst = np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        halves = []
        for rows in groups:
            side = _bisect(x[rows], rows, src, dst, near, part)
            halves += [rows[~side], rows[side]]
        groups = halves
        for k, rows in enumerate(groups):
            part[rows] = k
    return part


def _bisect(x: np.ndarray, rows: np.ndarray, src, dst, near: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Which rows of one part go to its second half."""
    n = len(rows)
    where = np.full(len(part), -1)
    where[rows] = np.arange(n)
    a = np.repeat(np.arange(n), near.shape[1])
    b = where[near[rows].ravel()]
    a, b = a[b >= 0], b[b >= 0]
    c = x - x.mean(axis=0)
    axis = np.ones(x.shape[1])
    for _ in range(20):  # the main direction, by power iteration
        axis = c.T @ (c @ axis)
        axis /= max(np.linalg.norm(axis), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(c @ axis, kind="stable")[n // 2:]] = True

    def gains(side):
        sign = np.where(side, 1, -1)
        pull = np.bincount(a, sign[b], n) + np.bincount(b, sign[a], n)
        return -sign * pull

    share = 0.1
    gain = gains(side)
    for _ in range(40):
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right), max(1, int(share * n / 2)))
        good = int((gain[left[:m]] + gain[right[:m]] > 0).sum())
        if not good:
            break
        new = side.copy()
        new[left[:good]], new[right[:good]] = True, False
        after = gains(new)
        if after.sum() < gain.sum():  # the sum of gains falls with the number of edges cut
            side, gain = new, after
        elif share * n < 4:
            break
        else:
            share /= 2
    return side


@dataclass
class Router:
    """A network with one hidden layer from vectors to the probabilities of the parts."""

    dim: int
    parts: int
    mean: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]
    share: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        z = np.maximum(((x - self.mean) / self.scale) @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(axis=1)

    def visits(self, x: np.ndarray) -> list[np.ndarray]:
        """Each row's most probable parts, until they hold the share."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
        n = (before < self.share).sum(axis=1) + 1
        return [o[:min(k, self.parts)] for o, k in zip(order, n)]


def train_router(x: np.ndarray, target: np.ndarray, seed: int = 7) -> Router:
    """Fit by Adam on the cross entropy of soft targets (a distribution over parts per row)."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), np.full(x.shape[1], max(x.std(), 1e-12))
    z = (x - mean) / scale
    parts = target.shape[1]
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        rate = RATE * (1 - epoch / EPOCHS)
        for lo in range(0, len(x), BATCH):
            at = order[lo:lo + BATCH]
            h = np.maximum(z[at] @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            p = np.exp(o - o.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - target[at]) / len(at)
            dh = (d @ w[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((z[at].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(x.shape[1], parts, mean, scale, tuple(w))


def fit_router(x: np.ndarray, rows: int, recall: float, k: int, seed: int = 7) -> Router:
    """The router of ``rows`` vectors from a sample of them."""
    x = x[np.lexsort(x.T)]  # whatever order the sample came in
    x = x[np.random.default_rng(seed).permutation(len(x))]
    unseen, x = x[:len(x) // HELD_OUT], x[len(x) // HELD_OUT:]
    parts = 1
    while parts < MAX_PARTS and parts * 2 * PART_ROWS <= rows and parts * 2 * PART_SAMPLE <= len(x):
        parts *= 2
    if parts == 1:
        return Router(x.shape[1], 1, np.zeros(x.shape[1]), np.ones(x.shape[1]),
                      (np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)))
    near = nearest_ids(x, x, EDGES, True)
    part = balanced_parts(x, near, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), near.shape[1] + 1), part[np.column_stack([np.arange(len(x)), near])].ravel()), 1)
    router = train_router(x, target / target.sum(axis=1, keepdims=True), seed)
    # The probability before the part of each true neighbour, most probable parts first.
    p = router.probabilities(unseen)
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.empty_like(p)
    np.put_along_axis(before, order, np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1), 1)
    needed = np.take_along_axis(before, router.home(x)[nearest_ids(unseen, x, k, False)], 1)
    router.share = float(np.quantile(needed, recall)) + 1e-9
    return router


class _Nearest:
    """The nearest of each query by exact Euclidean distance."""

    def __init__(self, k: int, label, extra):
        self.found = cells.Best(len(label), k)

    def add(self, a, at, ids, of, x) -> None:
        norm_a, norm_x = (a * a).sum(axis=1)[:, None], (x * x).sum(axis=1)[None, :]
        rough = 2 * (a @ x.T) - norm_a - norm_x
        slack = 1e-11 * (norm_a[:, 0] + norm_x.max())  # far above the rounding of the products
        r, c = self.found.near(rough, at, slack)
        for lo in range(0, len(r), 100_000):
            rr, cc = r[lo:lo + 100_000], c[lo:lo + 100_000]
            self.found.add(at[rr], -np.sqrt(((a[rr] - x[cc]) ** 2).sum(axis=1)), ids[cc])

    def best(self):
        key, score, ids = self.found.result()
        return key, np.zeros(len(key), np.int64), score, ids


def nearest_neighbours(vectors: DataFrame, queries: Column, k: int = 10, recall: float = 0.97, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each query, its own row left out.

    ``queries`` says by vec_id which rows are queries; ``recall`` is what the share of
    probability is set by.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & cells.finite("v") & F.exists("v", lambda e: e != 0)).distinct()
    kept = materialize(cells.first_of_equal(rows, ["v"], k + 1).withColumn("label", F.lit(None).cast("long")), "vectors")
    asked_rows = materialize(rows.where(queries), "queries")
    asked = materialize(asked_rows.select("v").distinct().select(F.monotonically_increasing_id().alias("c"), "v"), "asked")
    router, n = _fit(kept, recall, k)
    shared = spark.sparkContext.broadcast(router)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for main, other, b, x in _by_length(batches, shared.value.dim):
            cell = np.empty(b.num_rows, np.int64)
            cell[main], cell[other[0]] = shared.value.home(x), -other[1]
            yield pa.RecordBatch.from_arrays([pa.array(cell), *b.columns], names=["cell", *b.schema.names])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for main, other, b, x in _by_length(batches, shared.value.dim):
            got = np.empty(b.num_rows, object)
            for at, c in zip(main, shared.value.visits(x)):
                got[at] = c.tolist()
            for at, size in zip(*other):
                got[at] = [-int(size)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got.tolist(), pa.list_(pa.int64()))],
                                             names=[*b.schema.names, "cells"])

    placed = materialize(kept.select("vec_id", "label", "v").mapInArrow(
        task(place), "cell long, vec_id long, label long, v array<double>"), "parts")
    layout = cells.layout(placed, n)
    visits = asked.select("c", F.lit(None).cast("long").alias("label"), "v", F.lit(None).cast("array<double>").alias("extra")).mapInArrow(
        task(visit), "c long, label long, v array<double>, extra array<double>, cells array<long>")
    found = cells.scan(cells.dealt_rows(placed, layout), cells.dealt_queries(visits, layout),
                       lambda label, extra: _Nearest(k + 1, label, extra))
    best = materialize(cells.best_of(found, k + 1), "nearest")
    # Equal queries share a search; each leaves itself out.
    who = asked_rows.join(asked.select("c", F.col("v").alias("w")), F.col("v") == F.col("w")).select(F.col("vec_id").alias("query_id"), F.col("c").alias("qc"))
    mine = who.join(best, F.col("qc") == F.col("c")).where("id <> query_id OR score <> 0")
    order = Window.partitionBy("query_id", "c").orderBy(F.desc("score"), "id")
    return (mine.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)
            .select("query_id", F.col("nth").cast("int").alias("rank"), F.col("id").alias("vec_id"), F.abs("score").alias("score")))


def _by_length(batches: Iterator[pa.RecordBatch], dim: int):
    """Per 2,048 rows: those of length ``dim``, the others with their lengths, the rows, and the first's vectors."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            b = batch.slice(lo, 2048)
            values, offs = cells.flat(b.column("v"))
            size = np.diff(offs)
            main = size == dim
            other = np.flatnonzero(~main)
            yield np.flatnonzero(main), (other, size[other]), b, values[np.repeat(main, size)].reshape(-1, dim)


def _fit(kept: DataFrame, recall: float, k: int) -> tuple[Router, int]:
    """The router of the commonest length, fitted in one task on a bounded sample, and the number of rows."""
    import pickle

    sizes = kept.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    if most is None:
        return fit_router(np.zeros((1, 1)), 0, recall, k), 0
    dim, n = most["dim"], most["n"]
    share = max(1, -(-n // SAMPLE))
    sample = (kept.where((F.size("v") == dim) & (F.pmod(F.xxhash64("v"), F.lit(share)) == 0))
              .select("v").distinct().limit(2 * SAMPLE).repartition(1))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [cells.flat(b.column("v"))[0].reshape(-1, dim) for b in batches if b.num_rows]
        x = np.concatenate(x) if x else np.zeros((1, dim))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_router(x, n, recall, k))], pa.binary())], names=["router"])

    row = materialize(sample.mapInArrow(task(fit), "router binary"), "router").first()
    return pickle.loads(row["router"]), kept.count()
