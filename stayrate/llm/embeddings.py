"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Centroids are fitted on a bounded sample; every vector is then indexed in the cell of its
closest centroid.  A vector x, at home in h, is compared with the vectors of cell c unless one of two
bounds says that none of them can be within angle A of it, A = acos(threshold):

* the boundary of h and c is a plane at distance x.(h - c) / |h - c| from x, and a vector
  within A of x crosses at most sin A of that,
* no vector of c is further than R(c) from its centroid, so x must be within R(c) + A of it.

Both hold whatever the data, so no link is lost.  Where vectors form groups they leave few
cells; in many dimensions without groups they leave most, and the comparisons per vector
then grow with the table (``margin`` trades links for less: it searches planes only up to that
share of sin A).  Cells are compared as matrix products in double precision, slab by slab (``cells``);
a large cell is split over tasks.  Equal vectors are one class from the start, so copies are
never compared with each other.

Defined results: null or zero vectors and vectors with null or non-finite
components link with nothing; vectors of different lengths never link;
repeated ids are rows of their own; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm import cells
from stayrate.llm.components import components, merge_links
from stayrate.llm.store import materialize, ship, task

#: Distinct vectors that the centroids are fitted on, about.
SAMPLE = 32_768
#: Cells, at most: with SAMPLE it bounds what the driver and each task hold.
MAX_CELLS = 8_192
ITERATIONS = 8
#: Vectors of a slab at least (each vector travels once to every slab it visits), and compared at a time.
SLAB_ROWS = 8_192
PROBES = 512


def _unit(col: pa.Array, dim: int) -> np.ndarray:
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)  # so that no square is lost or overflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS, seed: int = 7) -> np.ndarray:
    """k unit centroids of unit rows, by Lloyd's steps on the sphere."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(iterations):
        near = np.concatenate([(x[lo:lo + 4096] @ c.T).argmax(axis=1) for lo in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        lost = norm[:, 0] < 1e-12
        total[lost] = x[rng.choice(len(x), int(lost.sum()))]
        c = total / np.where(lost[:, None], 1.0, norm)
    return c


def visited(x: np.ndarray, home: np.ndarray, c: np.ndarray, radius: np.ndarray, threshold: float, margin: float = 1.0) -> np.ndarray:
    """Which cells (columns) may hold a vector linked with each unit row; -1 is the radius of an empty cell."""
    s = np.clip(x @ c.T, -1, 1)
    if threshold <= 0:
        near = np.ones(s.shape, bool)
    else:
        gap = s[np.arange(len(x)), home][:, None] - s
        apart = np.sqrt(np.maximum(2 - 2 * c[home] @ c.T, 0))
        near = gap <= margin * (1 - threshold ** 2) ** 0.5 * apart + 1e-9
        near &= np.arccos(s) <= radius + np.arccos(threshold) + 1e-6
    near[:, radius < 0] = False
    near[np.arange(len(x)), home] = True
    return near


def embedding_links(vectors: DataFrame, threshold: float = 0.95, margin: float = 1.0, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for every vector; below 1, ``margin`` may lose links."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    usable = (F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
              & F.exists("v", lambda e: e != 0))
    rows = rows.withColumn("v", F.when(usable, F.col("v")))
    classes = materialize(rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(F.monotonically_increasing_id().alias("c"), "v", F.size("v").alias("dim"), "first", "n"), "vectors")
    dims = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        found = spark.createDataFrame([], "c long, links long, near long")
    else:
        found = materialize(_compare(classes, dims["dim"], dims["n"], threshold, margin), "vector-links")
    links = found.groupBy("c").agg((F.sum("links") - 1).alias("n_links"))
    group = components(found.select(F.col("c").alias("u"), F.col("near").alias("v")))
    owner = (classes.select("c", "v", "first").join(group, F.col("c") == F.col("node"), "left")
             .select("c", "v", "first", F.coalesce("component", "c").alias("component")))
    ids = owner.groupBy("component").agg(F.min("first").alias("component_id"))
    owner = owner.join(ids, "component").join(links, "c").select("v", "n_links", "component_id")
    out = rows.join(owner.withColumnRenamed("v", "w"), F.col("v") == F.col("w"), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _compare(classes: DataFrame, dim: int, n: int, threshold: float, margin: float) -> DataFrame:
    """(c, links, near): per class and slab, linked vectors (itself included) and one linked class."""
    k = max(1, min(MAX_CELLS, round(n ** 0.5), n))
    share = max(1, -(-n // SAMPLE))
    sample = (classes.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("v"), F.lit(share)) == 0)).select("v").limit(2 * SAMPLE).toArrow())
    if not sample.num_rows:
        sample = classes.where(F.col("dim") == dim).select("v").limit(1).toArrow()
    x = _unit(sample.column("v").combine_chunks(), dim)
    x = x[np.lexsort(x.T)]
    shared = classes.sparkSession.sparkContext.broadcast(spherical_kmeans(x, min(k, len(x))))

    def parts(batches: Iterator[pa.RecordBatch]):
        """Rows, those of the common length, the other lengths, and the unit vectors."""
        for batch in batches:
            for lo in range(0, batch.num_rows, PROBES):
                b = batch.slice(lo, PROBES)
                size = b.column("dim").to_numpy()
                main = np.flatnonzero(size == dim)
                yield b, main, np.where(size == dim, 0, -size.astype(np.int64)), _unit(b.column("v").take(pa.array(main)), dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, main, cell, x in parts(batches):
            s = x @ shared.value.T
            cell[main] = s.argmax(axis=1)
            away = np.zeros(len(cell))
            away[main] = np.arccos(np.clip(s.max(axis=1, initial=-1), -1, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(away), b.column("c"), b.column("n"), b.column("dim"), b.column("v").cast(pa.list_(pa.float64()))],
                names=["cell", "away", "vec_id", "label", "dim", "v"])

    placed = materialize(classes.mapInArrow(
        task(place), "cell long, away double, vec_id long, label long, dim int, v array<double>"), "cells")
    radius = np.full(len(shared.value), -1.0)
    for r in placed.where("cell >= 0 AND dim = " + str(dim)).groupBy("cell").agg(F.max("away").alias("r")).collect():  # a row per cell
        radius[r["cell"]] = r["r"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, main, other, x in parts(batches):
            home = b.column("cell").to_numpy()
            near = visited(x, home[main], shared.value, radius, threshold, margin)
            lists: list = [[int(c)] for c in home]
            for at, row in zip(main.tolist(), near):
                lists[at] = np.flatnonzero(row).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("v"), pa.nulls(b.num_rows, pa.list_(pa.float64())), pa.array(lists, pa.list_(pa.int64()))],
                names=["c", "label", "v", "extra", "cells"])

    layout = cells.layout(placed, placed.count(), SLAB_ROWS)
    visits = placed.mapInArrow(task(visit), "c long, label long, v array<double>, extra array<double>, cells array<long>")
    return cells.scan(cells.dealt_rows(placed.drop("dim", "away"), layout), cells.dealt_queries(visits, layout), threshold,
                      _LinkSlab, "c long, links long, near long")


class _LinkSlab(cells.Slab):
    """Links of the visiting vectors with the slab's; links that visitors make between these are one set each."""

    def _index(self) -> None:
        super()._index()
        self.cells = {cell: (c, n, x / np.linalg.norm(x, axis=1, keepdims=True)) for cell, (c, n, x) in
                      ((k, (c, n, x / np.abs(x).max(axis=1, keepdims=True))) for k, (c, n, x) in self.cells.items())}
        self.label = {cell: np.arange(len(c)) for cell, (c, _, _) in self.cells.items()}

    def compare(self) -> Iterator[pa.RecordBatch]:
        b = self.take()
        if b is None:
            return
        who = b.column("id").to_numpy()
        for cell, at, a in self.visits(b):
            c, n, x = self.cells[cell]
            a = a / np.abs(a).max(axis=1, keepdims=True)
            near = (a / np.linalg.norm(a, axis=1, keepdims=True)) @ x.T >= self.scorer
            some = np.flatnonzero(near.any(axis=1))
            if len(some):
                near = near[some]
                first = near.argmax(axis=1)
                r, h = np.nonzero(near)
                merge_links(self.label[cell], h, first[r])
                yield _rows(who[at[some]], near @ n, c[first])

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.compare()
        if self.parts or not hasattr(self, "label"):
            return
        for cell, label in self.label.items():
            apart = np.flatnonzero(label != np.arange(len(label)))
            if len(apart):
                c = self.cells[cell][0]
                yield _rows(c[apart], np.zeros(len(apart), np.int64), c[label[apart]])


def _rows(c, links, near) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(links, pa.int64()), pa.array(near, pa.int64())],
                                      names=["c", "links", "near"])
