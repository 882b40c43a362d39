"""K-Means of many models at once: one aggregate per iteration updates all of them.

Models are (k, seed) pairs.  Their centroids stand side by side in one matrix, so one
pass over the rows assigns each row in every model with a single matrix product, and one
aggregate by centroid gives all new centroids.  Models that no longer move leave the pass.
What reaches the driver per pass is a row per centroid.

Where the first centroids are drawn from a part of the rows, each model first settles on that part,
a task per model, so that few of the passes over all rows are spent on the way from a poor start.
A model ends, as without it, when no centroid moves any more over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that the first centroids are drawn from, about, and rows assigned at a time.
SAMPLE = 16_384
ROWS = 4_096


@dataclass
class KMeansRun:
    k: int
    seed: int
    centroids: np.ndarray
    inertia: float = float("nan")
    iterations: int = 0


def first_centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows drawn one after the other, each with a chance in proportion to its squared distance from those drawn."""
    rng = np.random.default_rng(seed)
    out = [x[rng.integers(len(x))]]
    d = ((x - out[0]) ** 2).sum(axis=1)
    while len(out) < k:
        total = d.sum()
        at = rng.choice(len(x), p=d / total) if total > 0 else rng.integers(len(x))
        out.append(x[at])
        d = np.minimum(d, ((x - x[at]) ** 2).sum(axis=1))
    return np.array(out)


def fit_many(rows: DataFrame, models: Sequence[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4,
             vector: str = "x") -> list[KMeansRun]:
    """Lloyd's algorithm for every (k, seed), to convergence (no centroid moves further than ``tol``).

    ``rows`` is read once per iteration: persist it.  Vectors are arrays of doubles; null ones are
    left out.  A centroid that loses its rows stays where it is.  Without rows there are no runs.
    """
    rows = rows.select(F.col(vector).alias("x")).where("x IS NOT NULL")
    n = rows.count()
    if not n:
        return []
    share = max(1, n // SAMPLE)
    sample = rows.where(F.pmod(F.xxhash64("x"), F.lit(share)) == 0).limit(2 * SAMPLE).collect() or rows.limit(1).collect()
    x = np.array([r["x"] for r in sample], float)
    x = x[np.lexsort(x.T[::-1])]
    runs = [KMeansRun(k, seed, first_centroids(x, k, seed)) for k, seed in models]
    if len(x) < n:
        for run, c in zip(runs, settled(rows.sparkSession, x, [r.centroids for r in runs], max_iter, tol)):
            run.centroids = c
    active = list(runs)
    for _ in range(max_iter):
        moved = []
        for run, (count, _, total) in zip(active, one_pass(rows, active)):
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], run.centroids)
            run.iterations += 1
            if ((new - run.centroids) ** 2).sum(axis=1).max() > tol * tol:
                moved.append(run)
            run.centroids = new
        active = moved
        if not active:
            break
    for run, (_, cost, _) in zip(runs, one_pass(rows, runs)):
        run.inertia = float(cost.sum())
    return runs


def settled(spark: SparkSession, x: np.ndarray, starts: Sequence[np.ndarray], max_iter: int, tol: float) -> list[np.ndarray]:
    """Lloyd's algorithm over the rows ``x`` from each of the starts, a task each."""
    import numpy as np

    sample = spark.sparkContext.broadcast(x)

    def settle(c):
        x = sample.value
        for _ in range(max_iter):
            near = ((c * c).sum(axis=1) / 2 - x @ c.T).argmin(axis=1)
            count = np.bincount(near, minlength=len(c))
            total = np.stack([np.bincount(near, v, len(c)) for v in x.T], axis=1)
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], c)
            moved = ((new - c) ** 2).sum(axis=1).max()
            c = new
            if moved <= tol * tol:
                break
        return c

    out = spark.sparkContext.parallelize(list(starts), len(starts)).map(settle).collect()
    sample.unpersist()
    return out


def one_pass(rows: DataFrame, runs: Sequence[KMeansRun]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per run the number of rows, squared distances and sums of rows of each centroid."""
    import numpy as np
    import pyarrow as pa

    centres = np.concatenate([r.centroids for r in runs])
    first = np.concatenate([[0], np.cumsum([r.k for r in runs])])
    n, d, step = len(centres), centres.shape[1], ROWS

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (centres * centres).sum(axis=1)[:, None] / 2
        cost, total = np.zeros(n), np.zeros((n, 1 + d))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                x = batch.slice(lo, step).column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                m, far = len(x), half - centres @ x.T
                squares, mine = (x * x).sum(axis=1), np.zeros((n, m))  # 1 where a row is a centroid's
                for a, z in zip(first[:-1], first[1:]):
                    at, least = np.zeros(m, np.intp), far[a]
                    for k in range(a + 1, z):  # the first of equally near ones
                        at = np.where(far[k] < least, k - a, at)
                        least = np.minimum(far[k], least)
                    mine[a + at, np.arange(m)] = 1
                    cost[a:z] += np.bincount(at, np.maximum(squares + 2 * least, 0), z - a)
                total += mine @ np.column_stack([np.ones(m), x])
        count, total = total[:, 0], total[:, 1:].T
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n), pa.int32()), pa.array(count), pa.array(cost), *(pa.array(t) for t in total)],
            names=["slot", "n", "cost", *(f"s{k}" for k in range(d))])

    sums = ["n", "cost", *(f"s{k}" for k in range(d))]
    part = rows.mapInArrow(assign, "slot int, " + ", ".join(f"{c} double" for c in sums))
    out = np.zeros((n, 2 + d))
    for r in part.groupBy("slot").agg(*[F.sum(c).alias(c) for c in sums]).collect():
        out[r["slot"]] = r[1:]
    return [(out[a:b, 0], out[a:b, 1], out[a:b, 2:]) for a, b in zip(first[:-1], first[1:])]
