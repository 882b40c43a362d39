"""Second-order histogram boosting on Spark.

Features are cut once into quantile bins; a row is then a string of bytes.  Every tree
grows level by level: one distributed pass adds up gradients and Hessians per node,
feature and bin, and the best split of every node follows from those sums alone
(gain 1/2 [GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)] - gamma, leaf -G/(H+l)).  Rows without a
value go to the side with the larger gain.

A pass is a job over cached blocks of arrays, without a plan to make: a tree takes as many jobs as it has
levels, and on small tables a job costs more than its work.  It sends one histogram per task, a feature taking as many numbers as it has bins.  While a
level's histograms of all tasks are within ``DIRECT_BYTES`` the driver adds them up, and of two
children only the lighter one's rows are counted: the other's sums are its parent's less those.
Beyond it histograms are shuffled by node and feature and only the best split of each leaves the
tasks, so the driver holds a row per node and feature.

Objectives: "squared"; "logistic"; "deviance", which is logistic with splits by the squared error
of the residuals and a Newton step per leaf (gradient boosting of the first order).

Rows lie in blocks of joint codes.  Features whose bins in use multiply to at most ``JOINT`` share a code
and are counted at once; a feature's sums are the margins of its group's, so they are the same to rounding.
A pass goes only down to the rows of the nodes it counts.  A tree's first pass brings the margins up to
the tree before and keeps them, so a row meets each tree once; every ``TREES_PER_CHECKPOINT`` trees
they are written to the checkpoint folder, so a lost executor repeats a bounded number of trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.operators.store import register_model
from stayrate.session import cut_lineage

#: Bins of a feature at most; the byte of a missing value.
MAX_BINS = 64
MISSING = 255
TREES_PER_CHECKPOINT = 25
DIRECT_BYTES = 64 << 20
#: Rows of a block.
BLOCK = 131_072
#: Rows of a task at most; up to that there is a task for each core.
TASK_ROWS = 4 << 20
#: Cells of a group of features at most, and numbers that a task's sums over all groups take at most.
JOINT = 8_192
CELLS = 4 << 20
#: Gains closer than this (relative) are equal: then the first feature and the first bin win.
SAME_GAIN = 1e-9
#: Gains below this share of the labels' sum of squares are rounding.
NO_GAIN = 1e-14


@dataclass
class Tree:
    """Nodes in heap order: children of i are 2i + 1 and 2i + 2; feature -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    weight: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def arrays(self) -> tuple:
        return self.feature, self.cut, self.missing_left, self.weight


def _kernels() -> tuple[Callable, Callable, Callable, Callable]:
    """The functions that tasks run; nested, so that they travel with the job."""
    import numpy as np

    missing_byte, same = MISSING, SAME_GAIN

    def walk(bins, tree):
        feature, cut, missing_left, _ = tree
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = feature[node]
            live = f >= 0
            if not live.any():
                return node
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == missing_byte, missing_left[node], b <= cut[node])
            node = np.where(live, 2 * node + 2 - left, node)

    def binned(x, cuts):
        out = np.empty(x.shape, np.uint8)
        for f, c in enumerate(cuts):
            out[:, f] = np.where(np.isnan(x[:, f]), missing_byte, np.searchsorted(c, x[:, f]))
        return out

    def derivatives(objective, y, w, margin):
        if objective == "logistic":
            p = 1 / (1 + np.exp(-margin))
            return w * (p - y), np.maximum(w * p * (1 - p), 1e-16)
        if objective == "deviance":
            return w / (1 + np.exp(-margin)) - w * y, w
        return w * (margin - y), w

    def best_splits(sums, lam, gamma, least):
        """Rows of cut, missing left, gain, GL, HL, G, H for sums (2, rows, bins); the last bin is of missing values."""
        g, h = sums
        every = np.arange(g.shape[0])
        total_g, total_h = g.sum(axis=1), h.sum(axis=1)
        gl, hl = np.cumsum(g[:, :-1], axis=1)[:, :-1], np.cumsum(h[:, :-1], axis=1)[:, :-1]
        out = np.zeros((len(every), 7))
        out[:, 2], out[:, 5], out[:, 6] = -np.inf, total_g, total_h
        for miss in (False, True):
            a, b = (gl + g[:, -1:], hl + h[:, -1:]) if miss else (gl, hl)
            right_g, right = total_g[:, None] - a, total_h[:, None] - b
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = 0.5 * (a * a / (b + lam) + right_g ** 2 / (right + lam) - (total_g ** 2 / (total_h + lam))[:, None]) - gamma
            gain = np.where((b >= least) & (right >= least), gain, -np.inf)
            if not gain.shape[1]:
                continue
            top = gain.max(axis=1)
            real = np.isfinite(top)
            near = np.where(real, top - same * np.abs(np.where(real, top, 0)), np.inf)
            at = (gain >= near[:, None]).argmax(axis=1)  # the first of equal gains
            value = gain[every, at]
            better = real & (value > np.where(np.isfinite(out[:, 2]), out[:, 2] + same * np.abs(np.where(real, top, 0)), -np.inf))
            new = np.stack([at, np.full(len(at), miss), value, a[every, at], b[every, at]], axis=1)
            out[better, :5] = new[better]
        return out

    return walk, binned, derivatives, best_splits


@register_model
@dataclass
class BoostedModel:
    objective: str
    base: float
    rate: float
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        walk, binned, _, _ = _kernels()
        b = binned(x, self.cuts)
        return self.base + sum((self.rate * t.weight[walk(b, t.arrays())] for t in self.trees), np.zeros(len(x)))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds ``prediction`` and, for the logistic objective, ``probability`` of class 1."""
        walk, binned, _, _ = _kernels()
        base, rate, cuts, trees = self.base, self.rate, self.cuts, [t.arrays() for t in self.trees]
        logistic, n = self.objective != "squared", len(self.cuts)
        import numpy as np
        import pyarrow as pa

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    part = batch.slice(lo, 4096)
                    x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                    b, m = binned(x, cuts), np.full(len(x), base)
                    for t in trees:
                        m += rate * t[3][walk(b, t)]
                    p = 1 / (1 + np.exp(-m))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[1:], pa.array((p >= 0.5).astype(float) if logistic else m), *([pa.array(p)] if logistic else [])],
                        names=[*part.schema.names[1:], "prediction", *(["probability"] if logistic else [])])

        keep = [f for f in df.schema if f.name != features]
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
        out = df.select(vector_to_array(features).alias("_x"), *[f.name for f in keep])
        return out.mapInArrow(run, f"{shape}, prediction double" + (", probability double" if logistic else ""))

    def importances(self) -> np.ndarray:
        """Mean gain of each feature's splits, as shares."""
        total, n = np.zeros(len(self.cuts)), np.zeros(len(self.cuts))
        for t in self.trees:
            at = t.feature >= 0
            np.add.at(total, t.feature[at], t.gain[at])
            np.add.at(n, t.feature[at], 1)
        mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
        return mean / mean.sum() if mean.sum() > 0 else mean

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances())

    def to_json(self) -> str:
        trees = [{k: getattr(t, k).tolist() for k in ("feature", "cut", "missing_left", "weight", "gain")} for t in self.trees]
        return json.dumps({"objective": self.objective, "base": self.base, "rate": self.rate,
                           "cuts": [c.tolist() for c in self.cuts], "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> "BoostedModel":
        d = json.loads(text)
        kinds = {"feature": np.int64, "cut": np.int64, "missing_left": bool, "weight": float, "gain": float}
        return cls(d["objective"], d["base"], d["rate"], [np.array(c, float) for c in d["cuts"]],
                   [Tree(**{k: np.array(t[k], v) for k, v in kinds.items()}) for t in d["trees"]])


@register_model
@dataclass
class GradientBoostedModel(BoostedModel):
    """Boosted trees of the first order: importances are total gains."""

    def importances(self) -> np.ndarray:
        """Each tree's gains by feature as shares, then their mean as shares."""
        out = np.zeros(len(self.cuts))
        for t in self.trees:
            at, one = t.feature >= 0, np.zeros(len(self.cuts))
            np.add.at(one, t.feature[at], t.gain[at])
            out += one / one.sum() if one.sum() > 0 else 0
        return out / out.sum() if out.sum() > 0 else out


def quantile_cuts(rows: DataFrame, n: int, bins: int = MAX_BINS) -> list[np.ndarray]:
    """Different values at the quantiles of each of the ``n`` features of the array column x."""
    # As SQL text: an expression tree of a literal per feature and quantile takes longer to build than to run.
    probs = ", ".join(f"{k / bins!r}D" for k in range(1, bins))
    row = rows.selectExpr(*[f"percentile_approx(CASE WHEN NOT isnan(x[{i}]) THEN x[{i}] END, array({probs}), {20 * bins}) AS q{i}"
                            for i in range(n)]).first()
    return [np.unique(np.array(q or [], float)) for q in row]


def fit_boosted(df: DataFrame, label: str, features: str = "features", weight: str | None = None, objective: str = "squared",
                n_trees: int = 200, depth: int = 6, rate: float = 0.1, lam: float = 1.0, gamma: float = 0.0,
                min_child_weight: float = 1.0, cuts: Sequence[np.ndarray] | None = None, bins: int = MAX_BINS) -> BoostedModel:
    """Boosted trees for ``objective`` "squared", "logistic" or "deviance" (labels 0 and 1).

    Rows with a null label are left out; a null weight is 1.  No rows give the base alone.
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    rows = df.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w"))
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        return BoostedModel(objective, 0.0, rate, [])
    n = first["n"]
    cuts = list(cuts) if cuts is not None else quantile_cuts(rows, n, bins)
    wy = F.col("w") * F.col("y")
    mean, squares, many = rows.agg((F.sum(wy) / F.sum("w")).alias("m"), F.sum(wy * F.col("y")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    if objective != "squared":
        mean = float(np.log(max(mean, 1e-9) / max(1 - mean, 1e-9)))
    model = BoostedModel(objective, float(mean), rate, cuts)
    data = _binned(rows, many, cuts, float(mean), depth)
    tasks = data.rows.getNumPartitions()
    stale = None
    for k in range(n_trees):
        tree = _grow(data, tasks, model, depth, lam, gamma, min_child_weight, NO_GAIN * squares)
        if stale is not None:  # the passes above have made what followed it
            stale.rows.unpersist()
        model.trees.append(tree)
        if tree.feature[0] < 0 and abs(tree.weight[0]) < 1e-9:  # nothing left to gain
            break
        stale, data = data, _advanced(data, tree, rate)
        if (k + 1) % TREES_PER_CHECKPOINT == 0:
            data.rows.checkpoint()  # with the next pass
    data.rows.unpersist()
    if stale is not None:
        stale.rows.unpersist()
    return model


def _groups(used: list[np.ndarray], rows: int, depth: int) -> list[list[int]]:
    """Features counted together, by the bins that each has in use: widest first, each to the first group with
    room.  A group has no more cells than is worth it for ``rows`` rows a task."""
    limit = min(JOINT, max(256, rows // 8))
    while True:
        out: list[list[int]] = []
        cells: list[int] = []
        for f in sorted(range(len(used)), key=lambda f: -len(used[f])):
            k = next((k for k, c in enumerate(cells) if c * len(used[f]) <= limit), len(out))
            if k == len(out):
                out.append([])
                cells.append(1)
            out[k].append(f)
            cells[k] *= max(1, len(used[f]))
        if limit <= 256 or (2 << max(depth - 1, 0)) * sum(cells) <= CELLS:
            return out
        limit //= 2


def _joint() -> tuple[Callable, Callable]:
    """Codes of a group, and sums by code as sums by bin; nested, so that they travel with the job."""
    import numpy as np

    def encode(bins, group, used):
        """Places in the grid of the bins in use, for rows given by a feature's bytes side by side."""
        out = np.zeros(bins.shape[1], np.uint16)
        for f in group:
            place = np.zeros(256, np.uint16)
            place[used[f]] = np.arange(len(used[f]))
            out = out * np.uint16(len(used[f])) + place[bins[f]]
        return out

    def margins(sums, group, used):
        """(feature, sums by bin in use) of sums (rows, cells)."""
        for f in reversed(group):
            grid = sums.reshape(len(sums), -1, len(used[f]))
            yield f, grid.sum(axis=1)
            sums = grid.sum(axis=2)

    return encode, margins


@dataclass
class Blocks:
    """Cached blocks of (codes by group, labels, weights, margins); the groups and the bins in use of each feature."""

    rows: RDD
    groups: list[list[int]]
    used: list[np.ndarray]


def _descent(groups: list[list[int]], used: list[np.ndarray]) -> Callable:
    """A function of a block's codes and a tree: (node, its rows) of the tree's leaves, or of those wanted."""
    home = {}  # per feature its group, and the cells before and after it in the grid
    for i, group in enumerate(groups):
        sizes = [len(used[f]) for f in group]
        home |= {f: (i, math.prod(sizes[:j]), math.prod(sizes[j + 1:])) for j, f in enumerate(group)}
    missing_byte = MISSING

    def descend(codes, tree, wanted=None):
        feature, cut, missing_left, _ = tree
        above = None
        if wanted is not None:
            above = set()
            for k in wanted:
                while k not in above:
                    above.add(k)
                    k = max(0, (k - 1) // 2)
        tasks = [(0, None)]
        while tasks:
            k, rows = tasks.pop()
            if above is not None and k not in above:
                continue
            f = feature[k]
            if f < 0:
                yield k, slice(None) if rows is None else rows
                continue
            i, before, after = home[f]
            to_left = (used[f] <= cut[k]) & (used[f] != missing_byte) | missing_left[k] & (used[f] == missing_byte)
            left = np.tile(np.repeat(to_left, after), before)[codes[i] if rows is None else codes[i][rows]]
            for child, those in ((2 * k + 2, ~left), (2 * k + 1, left)):
                if above is None or child in above:
                    tasks.append((child, np.flatnonzero(those) if rows is None else rows[those]))

    return descend


def _spread(rows: DataFrame) -> DataFrame:
    """Over all cores: small files make fewer partitions than a pass could use."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def _binned(rows: DataFrame, many: int, cuts: list[np.ndarray], base: float, depth: int) -> Blocks:
    """The ``many`` rows as blocks of joint codes, a task for each core; margins start at ``base``."""
    _, binned, _, _ = _kernels()
    import numpy as np
    import pyarrow as pa

    size, n = BLOCK, len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, size):
                batch = whole.slice(lo, size)
                b = binned(batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), cuts)
                parts = (b.T.tobytes(), *(batch.column(c).to_numpy().tobytes() for c in ("y", "w")))
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["bins", "y", "w"])

    # A pass waits for its slowest task, and many small tasks cost more than their work.
    spread = _spread(rows)
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, -(-many // TASK_ROWS))
    small = spread.mapInArrow(run, "bins binary, y binary, w binary")
    stored = cut_lineage(small if spread.rdd.getNumPartitions() == wanted else small.repartition(wanted)).rdd

    def together(parts: Iterator) -> Iterator[tuple]:
        """Small blocks as blocks of up to ``size`` rows: (a feature's bytes side by side, labels, weights)."""
        held, rows = [], 0
        for r in parts:
            y = np.frombuffer(r[1])
            if held and rows + len(y) > size:
                yield tuple(np.concatenate(h, axis=-1) for h in zip(*held))
                held, rows = [], 0
            held.append((np.frombuffer(r[0], np.uint8).reshape(n, len(y)), y, np.frombuffer(r[2])))
            rows += len(y)
        if held:
            yield tuple(np.concatenate(h, axis=-1) for h in zip(*held))

    def seen(parts: Iterator) -> Iterator[tuple]:
        rows, used = 0, np.zeros((n, 256), bool)
        for b, y, _ in together(parts):
            rows += len(y)
            for f in range(n):
                used[f] |= np.bincount(b[f], minlength=256) > 0
        yield rows, used

    found = stored.mapPartitions(seen).collect()
    bins_used = [np.flatnonzero(u) for u in sum((u for _, u in found), np.zeros((n, 256), bool))]
    groups = _groups(bins_used, max((m for m, _ in found), default=0), depth)
    encode, _ = _joint()

    def coded(parts: Iterator) -> Iterator[tuple]:
        for b, y, w in together(parts):
            yield [encode(b, group, bins_used) for group in groups], y, w, np.full(len(y), base)

    return Blocks(stored.mapPartitions(coded).persist(StorageLevel.MEMORY_AND_DISK), groups, bins_used)


def _advanced(data: Blocks, tree: Tree, rate: float) -> Blocks:
    """The margins with one more tree."""
    descend, t = _descent(data.groups, data.used), tree.arrays()

    def add(block):
        codes, y, w, margin = block
        margin = margin.copy()
        for k, rows in descend(codes, t):
            margin[rows] += rate * t[3][k]
        return codes, y, w, margin

    return Blocks(data.rows.map(add).persist(StorageLevel.MEMORY_AND_DISK), data.groups, data.used)


def _grow(data: Blocks, tasks: int, model: BoostedModel, depth: int, lam: float, gamma: float, least: float, floor: float) -> Tree:
    tree = Tree.empty(depth)
    open_, light, held = [0], [0], {}  # nodes to split, those whose rows are counted, sums of the nodes above
    for level in range(depth):
        splits, held = _level(data, tasks, model, tree, open_, light, held, lam, gamma, least)
        after, light = [], []
        for node in open_:
            best = splits.get(node)
            if best is None:
                continue
            f, cut, miss, gain, gl, hl, g, h = best
            if level == 0:
                tree.weight[0] = -g / (h + lam)
            if not gain > floor:
                continue
            tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = f, cut, miss, gain
            tree.weight[2 * node + 1], tree.weight[2 * node + 2] = -gl / (hl + lam), -(g - gl) / (h - hl + lam)
            after += [2 * node + 1, 2 * node + 2]
            light.append(2 * node + 1 if 2 * hl <= h else 2 * node + 2)
        open_ = after
        if not open_:
            break
    if model.objective == "deviance":
        _newton(data, tree, lam)
    return tree


def _newton(data: Blocks, tree: Tree, lam: float) -> None:
    """Leaves of the least deviance to second order: the sums of gradients and Hessians of their rows."""
    _, _, derivatives, _ = _kernels()
    descend = _descent(data.groups, data.used)
    import numpy as np

    grown, many = tree.arrays(), len(tree.feature)

    def sums(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        total = np.zeros((2, many))
        for codes, *rest in blocks:
            for k, rows in descend(codes, grown):
                total[:, k] += [s.sum() for s in derivatives("logistic", *(r[rows] for r in rest))]
        yield total

    g, h = sum(data.rows.mapPartitions(sums).collect())
    leaf = h > 0
    tree.weight[leaf] = -g[leaf] / (h[leaf] + lam)


def _level(data: Blocks, tasks: int, model: BoostedModel, tree: Tree, nodes: list[int], light: list[int], above: dict, lam: float,
           gamma: float, least: float) -> tuple[dict[int, tuple], dict]:
    """(feature, cut, missing left, gain, GL, HL, G, H) of the best split of each node, and the nodes' sums
    where the driver holds them.  ``light`` are the lighter children, ``above`` the sums of the level before."""
    _, _, derivatives, best_splits = _kernels()
    groups, used, descend = data.groups, data.used, _descent(data.groups, data.used)
    _, margins = _joint()
    import numpy as np

    n, widths = len(model.cuts), [len(c) + 2 for c in model.cuts]  # the last bin is of missing values
    width, starts = max(widths, default=2), np.concatenate([[0], np.cumsum(widths)]).astype(int)
    wide = int(starts[-1])
    # Where a feature's bins lie in the sums; ``wide`` is a place that stays zero.
    place_of = np.full((n, width), wide)
    for f, (lo, k) in enumerate(zip(starts, widths)):
        place_of[f, :k - 1], place_of[f, -1] = np.arange(lo, lo + k - 1), lo + k - 1
    counted = light if above else nodes
    direct = tasks * 16 * len(counted) * wide <= DIRECT_BYTES
    counted = counted if direct else nodes
    objective, grown = model.objective, tree.arrays()
    many, missing_byte = len(counted), MISSING
    place = {k: i for i, k in enumerate(counted)}

    def histogram(blocks):
        cells = [np.zeros((2, many, math.prod(len(used[f]) for f in group))) for group in groups]
        for codes, *rest in blocks:
            for k, rows in descend(codes, grown, counted):
                y, w, margin = (r[rows] for r in rest)
                g, h = derivatives(objective, y, w, margin)
                plain = h is w and len(w) and w.min() == 1 == w.max()
                for total, code in zip(cells, codes):
                    slot = code[rows].astype(np.intp)
                    total[0, place[k]] += np.bincount(slot, g, total.shape[2])
                    total[1, place[k]] += np.bincount(slot, None if plain else h, total.shape[2])
        out = np.zeros((2 * many, wide))
        for group, total in zip(groups, cells):
            for f, s in margins(total.reshape(2 * many, -1), group, used):
                out[:, starts[f] + np.where(used[f] == missing_byte, widths[f] - 1, used[f])] = s
        return out.reshape(2, many, wide)

    def whole(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        yield histogram(blocks)

    def padded(sums):
        """Sums (2, nodes, features, bins) with features of equal width."""
        return np.concatenate([sums, np.zeros((2, sums.shape[1], 1))], axis=2)[:, :, place_of]

    def by_feature(blocks: Iterator[tuple]) -> Iterator[tuple]:
        sums = histogram(blocks)
        for k in range(many):
            one = padded(sums[:, k:k + 1])
            yield from ((k * n + f, one[:, 0, f]) for f in range(n))

    def splits(sums: Iterator[tuple]) -> Iterator[tuple]:
        held = list(sums)  # a task's nodes and features
        if held:
            found = best_splits(np.stack([s for _, s in held], axis=1), lam, gamma, least)
            yield from ((*divmod(i, n), *r) for (i, _), r in zip(held, found.tolist()))

    held: dict = {}
    if direct:
        sums = sum(data.rows.mapPartitions(whole).collect())
        held = {k: sums[:, i] for i, k in enumerate(counted)}
        for k in nodes:
            if k not in held:
                other = k + 1 if k % 2 else k - 1
                held[k] = above[(k - 1) // 2] - held[other]
        found = best_splits(padded(np.stack([held[k] for k in nodes], axis=1)).reshape(2, len(nodes) * n, width), lam, gamma, least)
        rows = [(*divmod(i, n), *r) for i, r in enumerate(found.tolist())]
    else:
        rows = data.rows.mapPartitions(by_feature).reduceByKey(np.add, min(many * n, 3 * data.rows.ctx.defaultParallelism)).mapPartitions(splits).collect()
    out: dict[int, tuple] = {}
    for k, f, *rest in sorted(map(tuple, rows)):
        best = out.get(nodes[k])
        if best is None or rest[2] > best[3] + SAME_GAIN * abs(rest[2]):
            out[nodes[k]] = (f, *rest)
    return out, held
