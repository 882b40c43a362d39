"""Vectors in cells, dealt out in slabs to tasks that compare them with the queries visiting the cells.

A slab is a share of the cells of about equal size; a cell with more than a fraction
of a slab is cut into blocks that go to slabs of their own.  A query travels once to
each slab that holds a cell it visits, with the list of those cells.  Within a task a
slab's vectors come first, the queries follow in blocks, and each cell is compared with
its visitors as one matrix product.  What leaves the task is the best few per query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.store import task

#: Rows of a slab at most and at least, about, and slabs of a shuffle partition between these.
#: Each slab hands on the best few of a query, so slabs of few rows would only make more of them.
SLAB_ROWS = 65_536
LEAST_SLAB_ROWS = 1_024
SLABS_PER_TASK = 4
#: Cells that are cut into blocks, at most (see ``layout``).
HOT_CELLS = 65_536
#: Queries compared at a time, and candidates held before they are cut to the best.
PROBES = 512
HELD = 1_000_000
ROW_SCHEMA = "slab long, kind int, cell long, id long, label long, v array<double>, cells array<long>, extra array<double>"


def finite(v: str) -> Column:
    """Whether a vector is not null, not empty and all its components are finite numbers."""
    return (F.size(v) > 0) & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))


def first_of_equal(rows: DataFrame, same: list[str], n: int, id_col: str = "vec_id") -> DataFrame:
    """Of rows equal in ``same`` the ``n`` with the smallest ids.

    Equal rows score alike, so with ties to smaller ids no others are among any best
    ``n``.  Spark limits the groups before it shuffles them: a hot group is ``n`` rows a task.
    """
    order = Window.partitionBy(*same).orderBy(id_col)
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= n).drop("nth")


@dataclass(frozen=True)
class Layout:
    """How the cells are dealt out: slabs, and blocks of the cells that have more than one."""

    slabs: int
    cells: np.ndarray
    blocks: np.ndarray

    def slab(self, cell, block):
        return (cell * 7919 + block * 104_729) % self.slabs

    def visits(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slab, cell) of every block of the cells, by slab."""
        times = np.ones(len(cells), np.int64)
        if len(self.cells):
            at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
            times = np.where(self.cells[at] == cells, self.blocks[at], 1)
        each = np.repeat(cells, times)
        block = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
        both = np.unique(np.stack([self.slab(each, block), each]), axis=1)
        return both[0], both[1]


def layout(placed: DataFrame, n: int, least: int | None = None) -> Layout:
    """The layout of ``n`` rows with their ``cell``, in slabs of ``least`` rows or more (``LEAST_SLAB_ROWS``).

    Cells of over a quarter of a slab are cut, and of over n / ``HOT_CELLS`` rows where
    that is more, so the list of them is bounded.
    """
    for_tasks = SLABS_PER_TASK * int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slabs = max(1, min(for_tasks, n // (least or LEAST_SLAB_ROWS)), -(-n // SLAB_ROWS))
    most = max(1, n // slabs // 4, n // HOT_CELLS)
    hot = (placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)
           .select("cell", F.ceil(F.col("rows") / most).alias("blocks")).orderBy("cell").collect())
    return Layout(slabs, np.array([r["cell"] for r in hot], np.int64), np.array([r["blocks"] for r in hot], np.int64))


def dealt_rows(placed: DataFrame, out: Layout) -> DataFrame:
    """Rows (cell, vec_id, label, v) with their slab, for ``scan``."""
    block = F.lit(0)
    if len(out.cells):  # at most HOT_CELLS rows
        hot = placed.sparkSession.createDataFrame(list(zip(out.cells.tolist(), out.blocks.tolist())), "hot long, blocks long")
        placed = placed.join(F.broadcast(hot), F.col("cell") == F.col("hot"), "left")
        block = F.pmod(F.xxhash64("vec_id", "v"), F.coalesce("blocks", F.lit(1)))
    slab = F.pmod(F.col("cell") * 7919 + block * 104_729, F.lit(out.slabs)).cast("long")
    none = lambda t: F.lit(None).cast(t)
    return placed.select(slab.alias("slab"), F.lit(0).alias("kind"), "cell", F.col("vec_id").alias("id"),
                         F.col("label").cast("long").alias("label"), "v", none("array<long>").alias("cells"),
                         none("array<double>").alias("extra"))


def dealt_queries(queries: DataFrame, out: Layout) -> DataFrame:
    """Queries (c, label, v, cells, extra), once per slab that they visit, for ``scan``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, PROBES):
                b = batch.slice(lo, PROBES)
                slab, at, cells, cut = [], [], [], [0]
                for k, mine in enumerate(b.column("cells").to_pylist()):
                    s, c = out.visits(np.array(mine, np.int64))
                    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
                    slab.append(s[first])
                    at.append(np.full(len(first), k))
                    cells.append(c)
                    cut += (cut[-1] + np.append(first[1:], len(s))).tolist() if len(s) else []
                slab, at, cells = np.concatenate(slab), np.concatenate(at), np.concatenate(cells)
                for a in range(0, len(slab), PROBES):
                    z = min(a + PROBES, len(slab))
                    row = pa.array(at[a:z])
                    lists = pa.ListArray.from_arrays(pa.array(np.array(cut[a:z + 1]) - cut[a], pa.int32()), pa.array(cells[cut[a]:cut[z]]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slab[a:z]), pa.array(np.ones(z - a, np.int32)), pa.nulls(z - a, pa.int64()),
                         b.column("c").take(row), b.column("label").take(row), b.column("v").take(row), lists,
                         b.column("extra").take(row)],
                        names=["slab", "kind", "cell", "id", "label", "v", "cells", "extra"])

    return queries.mapInArrow(task(run), ROW_SCHEMA)


FOUND = "c long, slot int, score double, id long"


def scan(rows: DataFrame, queries: DataFrame, scorer: Callable, slab_of: Callable | None = None, found: str = FOUND) -> DataFrame:
    """(c, slot, score, id): per query and slot the best of each slab's cells that the query visits.

    ``slab_of(key, scorer)`` makes another kind of slab, with rows of its own (``found``).
    """
    slab_of = slab_of or Slab
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.union(queries).repartition(n_parts, "slab").sortWithinPartitions("slab", "kind", "cell", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("slab").to_numpy()
            edge = (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()
            for lo, hi in zip([0, *edge], [*edge, len(key)]):
                if slab is None or slab.key != key[lo]:
                    if slab is not None:
                        yield from slab.end()
                    slab = slab_of(key[lo], scorer)
                yield from slab.add(batch.slice(lo, hi - lo))
        if slab is not None:
            yield from slab.end()

    return both.mapInArrow(task(run), found)


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offs = col.offsets.to_numpy().astype(np.int64)
    return col.values.to_numpy(zero_copy_only=False)[offs[0]:offs[-1]], offs - offs[0]


class Slab:
    """A slab's vectors by cell, and the queries that wait to be compared with them."""

    def __init__(self, key: int, scorer: Callable):
        self.key, self.scorer = key, scorer
        self.parts: list[pa.RecordBatch] = []
        self.cells: dict[int, tuple] = {}
        self.waiting: list[pa.RecordBatch] = []
        self.n_waiting = 0

    def add(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_rows = int(np.searchsorted(b.column("kind").to_numpy(), 1))
        if n_rows:
            self.parts.append(b.slice(0, n_rows))
        for lo in range(n_rows, b.num_rows, PROBES):
            part = b.slice(lo, PROBES)
            self.waiting.append(part)
            self.n_waiting += part.num_rows
            if self.n_waiting >= PROBES:
                yield from self.compare()

    def _index(self) -> None:
        for b in self.parts:
            cell = b.column("cell").to_numpy()
            values, offs = flat(b.column("v"))
            edge = (np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()
            for lo, hi in zip([0, *edge], [*edge, len(cell)]):
                x = values[offs[lo]:offs[hi]].reshape(hi - lo, -1)
                label = b.column("label").slice(lo, hi - lo).fill_null(0).to_numpy()
                self.cells.setdefault(int(cell[lo]), []).append((b.column("id").to_numpy()[lo:hi], label, x))
        self.cells = {c: tuple(np.concatenate(p) for p in zip(*parts)) for c, parts in self.cells.items()}
        self.parts = []

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.compare()

    def take(self) -> pa.RecordBatch | None:
        """The waiting queries as one batch."""
        if not self.waiting:
            return None
        if self.parts:
            self._index()
        b = pa.Table.from_batches(self.waiting).combine_chunks().to_batches()[0]
        self.waiting, self.n_waiting = [], 0
        return b

    def visits(self, b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(cell, its visitors, their vectors) for every cell of the slab that queries of the batch visit."""
        values, offs = flat(b.column("v"))
        cells, cut = flat(b.column("cells"))
        who = np.repeat(np.arange(b.num_rows), np.diff(cut))
        order = np.argsort(cells, kind="stable")
        cells, who = cells[order], who[order]
        edge = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
        for lo, hi in zip(edge[:-1], edge[1:]):
            cell = int(cells[lo])
            if cell in self.cells:
                at = who[lo:hi]
                yield cell, at, values[offs[at][:, None] + np.arange(self.cells[cell][2].shape[1])]

    def compare(self) -> Iterator[pa.RecordBatch]:
        b = self.take()
        if b is None:
            return
        score = self.scorer(b.column("label").fill_null(0).to_numpy(), b.column("extra").to_pylist())
        for cell, at, a in self.visits(b):
            score.add(a, at, *self.cells[cell])
        who, slot, s, ids = score.best()
        if len(who):
            c = b.column("id").to_numpy()
            for lo in range(0, len(who), 20_000):
                z = slice(lo, lo + 20_000)
                yield pa.RecordBatch.from_arrays([pa.array(c[who[z]], pa.int64()), pa.array(slot[z].astype(np.int32)),
                                                  pa.array(s[z]), pa.array(ids[z], pa.int64())], names=["c", "slot", "score", "id"])


class Best:
    """The ``k`` best candidates of each of ``n`` keys: larger scores first, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.parts: list[tuple] = []
        self.held = 0

    def near(self, score: np.ndarray, key: np.ndarray, slack: float | np.ndarray = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(row, column) of scores that may be among the best of the rows' keys; -inf is none."""
        m = score.shape[1]
        if m >= self.k:
            kth = np.partition(score, m - self.k, axis=1)[:, m - self.k]
            self.floor[key] = np.maximum(self.floor[key], kth - slack)
        return np.nonzero((score >= self.floor[key][:, None]) & (score > -np.inf))

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(key):
            self.parts.append((key, score, ids))
            self.held += len(key)
            if self.held > HELD:
                self.parts = [self.result()]
                self.held = len(self.parts[0][0])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        key, score, ids = (np.concatenate(p) for p in zip(*self.parts))
        order = np.lexsort((ids, -score, key))
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        order = order[rank < self.k]
        return key[rank < self.k], score[order], ids[order]


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each (c, slot), ranked from 1."""
    order = Window.partitionBy("c", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
