"""Hard-negative mining with an inverted multi-index.

Vectors are cut into two halves, each with a codebook of its own fitted on a bounded
sample; a cell is a pair of codewords, so a few thousand codewords make millions of
cells.  Every vector is indexed.  For an anchor a = (a1, a2) no vector of cell (i, j)
scores above u(i) + w(j) with u(i) = a1.c(i) + |a1| r(i): c a codeword and r the largest
distance of any of its vectors from it.  A multi-sequence heap over the two sorted lists
of half-scores hands out cells by falling sum of the bounds, without sorting their
product.  Anchors visit cells in rounds, each some times longer than the last:

* the first search ends for an anchor when the bound of its next cell is below its last
  positive found, so that the positives are certified,
* the second when, for the window of every positive, that bound is below the window or
  below its last negative found.

Scores are exact integers.  Rows equal in vector and label score alike, so of each such
group only as many as can be wanted are indexed, and equal anchors are one query.

Defined results: rows with a null id or label, a null or empty vector or any null or
non-finite component take no part; rows equal in id, label and vector count once; rows
of one id and different vectors are rows of their own; vectors of different lengths never meet; a window of a negative positive score is empty;
other columns are ignored; an empty table gives an empty result.  Scores are exact while
the sums of products stay below 2^53.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm import cells
from stayrate.llm.store import materialize, ship, task

#: Vectors that the codebooks are fitted on, about, and codewords of a half at most.
SAMPLE = 32_768
MAX_WORDS = 2_048
#: Vectors of a cell that the number of codewords aims at.
CELL_ROWS = 64
ITERATIONS = 8
#: Cells of the first round, and how much longer the next ones are.
FIRST_CELLS = 64
LONGER = 32


def kmeans(x: np.ndarray, k: int, iterations: int = ITERATIONS, seed: int = 7) -> np.ndarray:
    """k centroids of the rows by Lloyd's steps."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(iterations):
        near = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        total[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
        c = total / np.maximum(n, 1)[:, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([(x[lo:lo + 2048] @ c.T - half).argmax(axis=1) for lo in range(0, len(x), 2048)] or [np.empty(0, np.int64)])


def multi_sequence(u: np.ndarray, w: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(u[i] + w[j], i, j) by falling sum: a heap over the two lists in falling order."""
    iu, iw = np.argsort(-u, kind="stable"), np.argsort(-w, kind="stable")
    su, sw = u[iu].tolist(), w[iw].tolist()
    iu, iw = iu.tolist(), iw.tolist()
    heap = [(-(su[0] + sw[0]), 0, 0)]
    done = [0] * len(su)  # entries of each row of the product that have been handed out
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, iu[i], iw[j]
        done[i] = j + 1
        # (i, j) enters once the entries to its left and above it have left.
        if i + 1 < len(su) and done[i + 1] == j:
            heapq.heappush(heap, (-(su[i + 1] + sw[j]), i + 1, j))
        if j + 1 < len(sw) and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (-(su[i] + sw[j + 1]), i, j + 1))


class MultiIndex:
    """The codebooks and radii of both halves, for vectors of one length."""

    def __init__(self, dim: int, books: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray] | None = None):
        self.dim, self.cut, self.books, self.radii = dim, dim // 2, books, radii

    def place(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Codewords of both halves and distances from them."""
        out = []
        for part, c in zip((x[:, :self.cut], x[:, self.cut:]), self.books):
            word = nearest(part, c)
            out += [word, np.sqrt(((part - c[word]) ** 2).sum(axis=1))]
        return out[0], out[2], out[1], out[3]

    def cells_of(self, a: np.ndarray, skip: int, budget: int, cut: float) -> tuple[list[int], float]:
        """The cells after the first ``skip`` of an anchor's sequence, at most ``budget`` of them and
        none below ``cut``, and the bound of the next one (-inf at the end)."""
        bounds = []
        for part, c, r in zip((a[:self.cut], a[self.cut:]), self.books, self.radii):
            norm = np.sqrt(part @ part)
            b = c @ part + norm * r
            # Above any rounding of the products; codewords without vectors are never worth a visit.
            bounds.append(np.where(r < 0, -np.inf, b + 1e-9 * (np.abs(c) @ np.abs(part) + norm * np.abs(r)) + 1e-6))
        words, out = len(self.books[1]), []
        for n, (bound, i, j) in enumerate(multi_sequence(*bounds)):
            if bound == -np.inf:
                break
            if n >= skip:
                if len(out) >= budget or bound < cut:
                    return out, bound
                out.append(i * words + j)
        return out, -np.inf


class _Positives:
    """The best of a query's own label."""

    def __init__(self, k: int, label: np.ndarray):
        self.label, self.found = label, cells.Best(len(label), k)

    def add(self, a, at, ids, of, x) -> None:
        s = np.where(of[None, :] == self.label[at][:, None], a @ x.T, -np.inf)
        r, c = self.found.near(s, at)
        self.found.add(at[r], s[r, c], ids[c])

    def best(self):
        key, score, ids = self.found.result()
        return key, np.zeros(len(key), np.int64), score, ids


class _Negatives:
    """The best of other labels in the window of each positive score."""

    def __init__(self, k: int, low: tuple[int, int], label: np.ndarray, extra: list):
        self.label, self.low = label, low
        self.width = max(map(len, extra), default=1)
        self.window = np.array([[*e, *[np.nan] * (self.width - len(e))] for e in extra])
        self.found = cells.Best(len(label) * self.width, k)

    def add(self, a, at, ids, of, x) -> None:
        s = np.where(of[None, :] != self.label[at][:, None], a @ x.T, -np.inf)
        least, whole = self.low
        for k in range(self.width):
            p = self.window[at, k][:, None]
            inside = np.where((s <= p) & (whole * s >= least * p), s, -np.inf)
            r, c = self.found.near(inside, at * self.width + k)
            self.found.add(at[r] * self.width + k, inside[r, c], ids[c])

    def best(self):
        key, score, ids = self.found.result()
        return key // self.width, key % self.width, score, ids


def _search(index: MultiIndex, rows: DataFrame, layout: cells.Layout, asked: DataFrame, scorer, k: int, cut: Column) -> DataFrame:
    """(c, slot, score, id, rank): the ``k`` best of each query (c, label, v, extra) and slot, certified.

    ``cut``: the bound below which no cell matters to a query, from ``low``, a map of
    the slots that have ``k`` rows to the score of their last.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(index)
    open_ = asked.select("c", "label", "v", "extra", F.lit(0).cast("long").alias("popped"), F.lit(float("-inf")).alias("cut"))
    found, budget = None, FIRST_CELLS
    while True:
        def visit(batches: Iterator[pa.RecordBatch], budget=budget) -> Iterator[pa.RecordBatch]:
            ix = shared.value
            for batch in batches:
                for lo in range(0, batch.num_rows, cells.PROBES):
                    b = batch.slice(lo, cells.PROBES)
                    values, offs = cells.flat(b.column("v"))
                    got, after = [], []
                    for n, skip, low in zip(range(b.num_rows), b.column("popped").to_pylist(), b.column("cut").to_pylist()):
                        a = values[offs[n]:offs[n + 1]]
                        here, bound = ix.cells_of(a, skip, budget, low) if len(a) == ix.dim else ([-len(a)], -np.inf)
                        got.append(here)
                        after.append(bound)
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(x) for x in ("c", "label", "v", "extra")), pa.array(got, pa.list_(pa.int64())),
                         pa.array([s + len(g) for s, g in zip(b.column("popped").to_pylist(), got)], pa.int64()),
                         pa.array(after, pa.float64())],
                        names=["c", "label", "v", "extra", "cells", "popped", "after"])

        visits = materialize(open_.mapInArrow(
            task(visit), "c long, label long, v array<double>, extra array<double>, cells array<long>, popped long, after double"), "visits")
        new = cells.scan(rows, cells.dealt_queries(visits, layout), scorer)
        new = new if found is None else new.union(found.drop("rank"))
        found = materialize(cells.best_of(new, k), "found")
        last = (found.where(F.col("rank") == k).groupBy("c")
                .agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("low")).withColumnRenamed("c", "of"))
        open_ = (visits.where("after > double('-inf')").join(last, F.col("c") == F.col("of"), "left").withColumn("cut", cut)
                 .where("after >= cut").select("c", "label", "v", "extra", "popped", "cut"))
        open_ = materialize(open_, "open")
        if open_.isEmpty():
            return found
        budget *= LONGER


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, window: tuple[int, int] = (80, 100),
                   id_col: str = "vec_id", vector_col: str = "v", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` holds integers (as doubles); ``anchors`` says by vec_id which rows are
    anchors.  ``window``: a negative of positive p scores within window[0] / window[1] p and p.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & cells.finite("v")).distinct()
    # The anchor itself may be one of its equals' first.
    kept = materialize(cells.first_of_equal(rows, ["v", "label"], positives + 1), "mined-vectors")
    asked_rows = materialize(rows.where(anchors), "anchors")
    asked = materialize(asked_rows.select("v", "label").distinct().select(
        F.monotonically_increasing_id().alias("c"), "label", "v", F.lit(None).cast("array<double>").alias("extra")), "asked")
    index, placed, n = _index(kept)
    layout = cells.layout(placed, n)
    dealt = cells.dealt_rows(placed, layout)

    own = _search(index, dealt, layout, asked, lambda label, extra: _Positives(positives + 1, label), positives + 1,
                  F.coalesce(F.try_element_at("low", F.lit(0)), F.lit(float("-inf"))))
    scores = own.groupBy("c").agg(F.sort_array(F.collect_set("score"), asc=False).alias("scores")).withColumnRenamed("c", "of")
    windows = asked.join(scores, F.col("c") == F.col("of")).select("c", "label", "v", F.col("scores").alias("extra"))
    least = F.transform("extra", lambda p, k: F.when(p < 0, F.lit(float("inf"))).otherwise(F.greatest(
        p * window[0] / window[1], F.coalesce(F.try_element_at("low", k), F.lit(float("-inf"))))))
    other = _search(index, dealt, layout, materialize(windows, "windows"),
                    lambda label, extra: _Negatives(negatives, window, label, extra), negatives, F.array_min(least))

    # Equal anchors share a query; each leaves itself out.
    itself = F.aggregate("av", F.lit(0.0), lambda t, e: t + e * e).alias("itself")
    who = (asked_rows.join(asked.select("c", F.col("v").alias("av"), F.col("label").alias("al")),
                           (F.col("v") == F.col("av")) & (F.col("label") == F.col("al")))
           .select(F.col("vec_id").alias("anchor_id"), "c", itself))
    mine = who.join(own.select(F.col("c").alias("oc"), F.col("id").alias("positive_id"), F.col("score").alias("positive")),
                    F.col("c") == F.col("oc")).where("positive_id <> anchor_id OR positive <> itself")
    order = Window.partitionBy("anchor_id", "c").orderBy(F.desc("positive"), "positive_id")
    mine = mine.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    slots = scores.select(F.col("of").alias("wc"), F.posexplode("scores").alias("slot", "p"))
    hard = (other.join(slots, (F.col("c") == F.col("wc")) & (other["slot"] == slots["slot"]))
            .select("wc", "p", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative")))
    return (mine.join(hard, (F.col("c") == F.col("wc")) & (F.col("positive") == F.col("p")))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
                    F.col("positive").cast("long").alias("positive_score"), F.col("negative").cast("long").alias("negative_score")))


def _index(kept: DataFrame) -> tuple[MultiIndex, DataFrame, int]:
    """The multi-index of the commonest length, all rows with their cell, and their number."""
    spark = kept.sparkSession
    sizes = kept.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "dim").first()
    dim, n = (most["dim"], most["n"]) if most else (2, 0)
    share = max(1, -(-n // SAMPLE))
    sample = kept.where((F.size("v") == dim) & (F.pmod(F.xxhash64("v"), F.lit(share)) == 0)).select("v").limit(2 * SAMPLE).toArrow()
    # A null-free sample in an order of its own, so that refitting gives the same codebooks.
    x = cells.flat(sample.column("v").combine_chunks())[0].reshape(-1, dim) if sample.num_rows else np.zeros((1, dim))
    x = x[np.lexsort(x.T)]
    k = max(1, min(MAX_WORDS, round((n / CELL_ROWS) ** 0.5), len(x)))
    index = MultiIndex(dim, (kmeans(x[:, :dim // 2], k), kmeans(x[:, dim // 2:], k)))
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                b = batch.slice(lo, 2048)
                values, offs = cells.flat(b.column("v"))
                size = np.diff(offs)
                main = size == dim
                i, j, ri, rj = (np.zeros(len(size), t) for t in (np.int64, np.int64, float, float))
                i[main], j[main], ri[main], rj[main] = shared.value.place(values[np.repeat(main, size)].reshape(-1, dim))
                cell = np.where(main, i * k + j, -size)  # a cell for each other length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(i), pa.array(j), pa.array(ri), pa.array(rj), *(b.column(c) for c in ("vec_id", "label", "v"))],
                    names=["cell", "i", "j", "ri", "rj", "vec_id", "label", "v"])

    placed = materialize(kept.select("vec_id", "label", "v").mapInArrow(
        task(place), "cell long, i long, j long, ri double, rj double, vec_id long, label long, v array<double>"), "cells")
    radii = []
    for word, r in (("i", "ri"), ("j", "rj")):  # a row per codeword
        out = np.full(k, -1.0)
        for row in placed.where("cell >= 0").groupBy(word).agg(F.max(r).alias("r")).collect():
            out[row[word]] = row["r"]
        radii.append(out)
    return MultiIndex(dim, index.books, (radii[0], radii[1])), placed, placed.count()
