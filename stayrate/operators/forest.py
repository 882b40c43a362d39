"""Random forests on Spark: large nodes by histograms, small ones whole in a task.

Features are cut once into quantile bins.  A tree sees a row as often as a Poisson draw says;
the draws follow from the seed, the row's stored block and the tree, so a repeated task draws
the same.  Nodes of more than ``HAND_OVER`` rows are split level by level: each task adds up
its rows per node, feature and bin, and the sums, which also say how many rows a child has,
meet by node.  The rows of a smaller node
then go to one task, which grows the rest of the subtree.  So what a tree ships is its rows
once and a few dense histograms, where a level-by-level forest ships a histogram per node, of
which deep trees have thousands, from every task.

The splits are those of least variance, which for labels 0 and 1 are those of least Gini
impurity; a leaf is the weighted mean of its labels.
"""

from __future__ import annotations

import base64
import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.operators.boosting import MISSING, SAME_GAIN, Tree, _kernels, _spread, quantile_cuts
from stayrate.operators.store import register_model
from stayrate.session import cut_lineage

#: Bins of a feature; rows of a node that one task finishes; rows of a stored block.
BINS = 32
HAND_OVER = 131_072
BLOCK = 65_536
#: Numbers in the histograms that a task holds at a time.
CELLS = 4 << 20
#: Gains below this share of a node's sum of squares are rounding.
NO_GAIN = 1e-12


def _growing():
    """The functions that tasks run; nested, so that they travel with the job."""
    import numpy as np

    _, _, _, best_splits = _kernels()
    missing_byte, cells, no_gain, same = MISSING, CELLS, NO_GAIN, SAME_GAIN

    def times(seed, part, block, tree, m):
        """How often the tree sees each of the block's rows."""
        return np.random.default_rng([seed, part, block, tree]).poisson(1.0, m)

    def choose(seed, tree, nodes, n, per_split):
        """(nodes, per_split) features that each node may split by, in ascending order."""
        if per_split >= n:
            return np.broadcast_to(np.arange(n), (len(nodes), n))
        return np.array([np.sort(np.random.default_rng([seed, tree, k, 1]).permutation(n)[:per_split]) for k in nodes])

    def histogram(b, node, y, w, feats, width):
        """Sums (2, nodes, features, bins) of w * y and w; ``feats`` are each node's features."""
        k, f = feats.shape
        if f == b.shape[1]:
            out, first, both = np.empty((2, k, f, width)), node * width, (w * y, w)
            for j in range(f):
                v = np.where(b[:, j] == missing_byte, width - 1, b[:, j]) if b[:, j].max(initial=0) == missing_byte else b[:, j]
                slot = first + v
                for i, s in enumerate(both):
                    out[i, :, j] = np.bincount(slot, s, k * width).reshape(k, width)
            return out
        v = np.take_along_axis(b, feats[node], 1)
        slot = np.where(v == missing_byte, width - 1, v) + width * (np.arange(f) + f * node[:, None])
        slot = slot.ravel()
        return np.stack([np.bincount(slot, np.repeat(s, f), k * f * width) for s in (w * y, w)]).reshape(2, k, f, width)

    def best(sums, feats):
        """Per node: feature, cut, missing left, gain, GL, HL, G, H; feature -1 where nothing is gained."""
        _, k, f, width = sums.shape
        found = best_splits(sums.reshape(2, k * f, width), 1e-12, 0.0, 1e-9).reshape(k, f, 7)
        gain = found[:, :, 2]
        at = (gain >= gain.max(axis=1, keepdims=True) * (1 - same)).argmax(axis=1)  # the first of equal ones
        out = found[np.arange(k), at]
        real = out[:, 2] > no_gain * out[:, 5] ** 2 / np.maximum(out[:, 6], 1e-12)
        return np.column_stack([np.where(real, feats[np.arange(k), at], -1), out])

    def finish(b, y, w, seed, tree, root, level, depth, per_split, width):
        """The subtree below ``root``, which is at ``level``: rows of node, feature, cut, missing left, weight, gain."""
        ids, starts, out = np.array([root]), np.array([0, len(y)]), []
        n = b.shape[1]
        f = min(n, per_split)
        while len(ids):
            g = np.add.reduceat(w * y, starts[:-1])
            h = np.add.reduceat(w, starts[:-1])
            if level == depth:
                out.append(np.column_stack([ids, np.full(len(ids), -1), np.zeros((len(ids), 2)), g / h, np.zeros(len(ids))]))
                break
            step = max(1, cells // (f * width * 2))
            splits = []
            for lo in range(0, len(ids), step):
                hi = min(lo + step, len(ids))
                a, z = starts[lo], starts[hi]
                node = np.repeat(np.arange(hi - lo), np.diff(starts[lo:hi + 1]))
                feats = choose(seed, tree, ids[lo:hi], n, per_split)
                total, part = 0.0, max(1, cells // f)
                for r in range(a, z, part):
                    e = min(r + part, z)
                    total = total + histogram(b[r:e], node[r - a:e - a], y[r:e], w[r:e], feats, width)
                splits.append(best(total, feats))
            s = np.concatenate(splits)
            s[s[:, 0] < 0, 1:4] = 0
            out.append(np.column_stack([ids, s[:, 0], s[:, 1], s[:, 2], g / h, s[:, 3]]))
            # Rows stay sorted by node: left child before right child, finished nodes go.
            node = np.repeat(np.arange(len(ids)), np.diff(starts))
            live = s[node, 0] >= 0
            b, y, w, node = b[live], y[live], w[live], node[live]
            v = b[np.arange(len(b)), s[node, 0].astype(int)]
            left = np.where(v == missing_byte, s[node, 2] > 0, v <= s[node, 1])
            child = 2 * node + 1 - left
            order = np.argsort(child, kind="stable")
            b, y, w = b[order], y[order], w[order]
            kept, sizes = np.unique(child, return_counts=True)
            ids = 2 * ids[kept // 2] + 1 + kept % 2
            starts = np.concatenate([[0], np.cumsum(sizes)])
            level += 1
        return np.concatenate(out)

    return times, choose, histogram, best, finish


@register_model
@dataclass
class ForestModel:
    """The mean of the trees; ``probability`` of class 1 and the likelier class for labels 0 and 1."""

    classes: bool
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        walk, binned, _, _ = _kernels()
        classes, cuts, trees, n = self.classes, self.cuts, [t.arrays() for t in self.trees], len(self.cuts)
        import numpy as np
        import pyarrow as pa

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    part = batch.slice(lo, 4096)
                    b = binned(part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, n), cuts)
                    m = np.zeros(len(b))
                    for t in trees:
                        m += t[3][walk(b, t)]
                    m /= max(len(trees), 1)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[1:], pa.array((m > 0.5).astype(float) if classes else m), *([pa.array(m)] if classes else [])],
                        names=[*part.schema.names[1:], "prediction", *(["probability"] if classes else [])])

        keep = [f for f in df.schema if f.name != features]
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
        out = df.select(vector_to_array(features).alias("_x"), *[f.name for f in keep])
        return out.mapInArrow(run, f"{shape}, prediction double" + (", probability double" if classes else ""))

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains by feature as shares, then their mean as shares."""
        out = np.zeros(len(self.cuts))
        for t in self.trees:
            at, one = t.feature >= 0, np.zeros(len(self.cuts))
            np.add.at(one, t.feature[at], t.gain[at])
            out += one / one.sum() if one.sum() > 0 else 0
        return DenseVector(out / out.sum() if out.sum() > 0 else out)

    def to_json(self) -> str:
        kept = {}
        for i, t in enumerate(self.trees):  # a deep tree has many places and few nodes
            node = np.flatnonzero((t.feature >= 0) | (t.weight != 0))
            kept |= {f"node{i}": node, f"size{i}": np.array(len(t.feature))}
            kept |= {f"{k}{i}": getattr(t, k)[node] for k in ("feature", "cut", "missing_left", "weight", "gain")}
        text = io.BytesIO()
        np.savez_compressed(text, **kept)
        return json.dumps({"classes": self.classes, "cuts": [c.tolist() for c in self.cuts], "n": len(self.trees),
                           "trees": base64.b64encode(text.getvalue()).decode()})

    @classmethod
    def from_json(cls, text: str) -> "ForestModel":
        d = json.loads(text)
        kept, trees = np.load(io.BytesIO(base64.b64decode(d["trees"]))), []
        for i in range(d["n"]):
            t = _blank(int(kept[f"size{i}"]))
            for k in ("feature", "cut", "missing_left", "weight", "gain"):
                getattr(t, k)[kept[f"node{i}"]] = kept[f"{k}{i}"]
            trees.append(t)
        return cls(d["classes"], [np.array(c, float) for c in d["cuts"]], trees)


def _blank(size: int) -> Tree:
    return Tree(np.full(size, -1, np.int16), np.zeros(size, np.uint8), np.zeros(size, bool), np.zeros(size), np.zeros(size))


def fit_forest(df: DataFrame, label: str, features: str = "features", weight: str | None = None, classes: bool = False,
               n_trees: int = 200, depth: int = 12, per_split: int | None = None, seed: int = 42, bins: int = BINS,
               hand_over: int = HAND_OVER) -> ForestModel:
    """``n_trees`` trees of at most ``depth`` splits on a path, each node split by one of ``per_split``
    features drawn for it (None: all).  Rows with a null label or no weight are left out.
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    rows = df.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), w.alias("w")).where("w > 0")
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        return ForestModel(classes, [])
    n = first["n"]
    model = ForestModel(classes, quantile_cuts(rows, n, bins), [_blank(2 ** (depth + 1) - 1) for _ in range(n_trees)])
    data = _blocks(rows, model.cuts, n)
    m = data.agg(F.sum("m")).first()[0]
    width = max((len(c) for c in model.cuts), default=0) + 2  # and one for missing values
    job = (seed, depth, min(n, per_split or n), width)
    # Nodes that wait for a task of their own by tree, and those to be split by histograms.
    waiting: list[tuple[int, int]] = [(t, 0) for t in range(n_trees)]
    large: list[tuple[int, int]] = waiting if m > hand_over else []
    waiting = [] if large else waiting
    for level in range(depth):
        if not large:
            break
        sizes = _split_large(data, model, large, n, job)
        if level + 1 == depth:  # leaves: their weights are known
            break
        waiting += [c for c in sizes if sizes[c] <= hand_over]
        large = [c for c in sizes if sizes[c] > hand_over]
    _finish_small(data, model, waiting, n, job)
    data.unpersist()
    return model


def _blocks(rows: DataFrame, cuts: Sequence[np.ndarray], n: int) -> DataFrame:
    """(part, block, m, bins, y, w): ``m`` rows at a time, as the bytes of their arrays."""
    _, binned, _, _ = _kernels()
    import numpy as np
    import pyarrow as pa

    cuts, size = list(cuts), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, held, many = TaskContext.get().partitionId(), 0, [], 0

        def block():
            b, y, w = (np.concatenate(h) for h in zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([len(b)], pa.int64()),
                 *(pa.array([p.tobytes()], pa.binary()) for p in (b, y, w))],
                names=["part", "block", "m", "bins", "y", "w"])

        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                piece = batch.slice(lo, size)
                if held and many + piece.num_rows > size:
                    yield block()
                    at, held, many = at + 1, [], 0
                b = binned(piece.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, n), cuts)
                held.append((b, piece.column("y").to_numpy(), piece.column("w").to_numpy()))
                many += len(b)
        if held:
            yield block()

    return cut_lineage(_spread(rows).mapInArrow(run, "part int, block long, m long, bins binary, y binary, w binary")).persist()


def _by_tree(model: ForestModel, nodes: Sequence[tuple[int, int]]) -> dict:
    """Per tree its arrays and the wanted nodes in ascending order."""
    ids: dict = {}
    for t, k in sorted(nodes):
        ids.setdefault(t, []).append(k)
    return {t: (model.trees[t].arrays(), np.array(k)) for t, k in ids.items()}


def _reader(n: int, seed: int):
    """For a block, a feature's bytes side by side, and a tree: each wanted node that has rows, by its place among
    them, and those rows with how often the tree sees each."""
    times, *_ = _growing()
    missing_byte = MISSING
    import numpy as np

    def blocks(batches):
        for batch in batches:
            for part, block, m, bins, y, w in zip(*(c.to_pylist() for c in batch.columns)):
                b = np.ascontiguousarray(np.frombuffer(bins, np.uint8).reshape(m, n).T)
                yield part, block, b, np.frombuffer(y), np.frombuffer(w)

    def seen(part, block, b, tree, arrays, ids):
        feature, cut, missing_left, _ = arrays
        c = times(seed, part, block, tree, b.shape[1])
        place, on_way = {int(k): i for i, k in enumerate(ids)}, set()
        for k in place:  # the nodes above, down to which rows are followed
            while k and k not in on_way:
                on_way.add(k)
                k = (k - 1) // 2
        todo = [(0, np.flatnonzero(c))]
        while todo:
            k, rows = todo.pop()
            if k in place:
                if len(rows):
                    yield place[k], rows, c[rows]
                continue
            if feature[k] < 0 or not len(rows):
                continue
            to_left = np.arange(256) <= cut[k]
            to_left[missing_byte] = missing_left[k]
            left = to_left[b[feature[k]][rows]]
            for child, those in ((2 * k + 2, ~left), (2 * k + 1, left)):
                if child in on_way:
                    todo.append((child, rows[those]))

    return blocks, seen


def _split_large(data: DataFrame, model: ForestModel, nodes: list[tuple[int, int]], n: int, job: tuple) -> dict[tuple[int, int], int]:
    """Split the nodes by histograms that meet by node; returns the children and how many rows each has."""
    seed, _, per_split, width = job
    blocks, seen = _reader(n, seed)
    _, choose, _, best, _ = _growing()
    missing_byte = MISSING
    import numpy as np
    import pyarrow as pa

    children: dict = {}
    spread = int(data.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, 4 * CELLS // (3 * per_split * width))
    nodes = sorted(nodes)
    for lo in range(0, len(nodes), step):
        wanted = _by_tree(model, nodes[lo:lo + step])

        def sums(batches: Iterator[pa.RecordBatch], wanted=wanted) -> Iterator[pa.RecordBatch]:
            # Per node and feature by bin: weighted labels, weights, rows.
            total = {t: np.zeros((len(ids), 3, per_split, width)) for t, (_, ids) in wanted.items()}
            feats = {t: choose(seed, t, ids, n, per_split) for t, (_, ids) in wanted.items()}
            for part, block, b, y, w in blocks(batches):
                gaps = b.max(axis=1, initial=0) == missing_byte
                for t, (arrays, ids) in wanted.items():
                    for i, rows, c in seen(part, block, b, t, arrays, ids):
                        ww = c * w[rows]
                        wy, out = ww * y[rows], total[t][i]
                        for j, f in enumerate(feats[t][i]):
                            slot = b[f][rows].astype(np.intp)
                            if gaps[f]:
                                slot[slot == missing_byte] = width - 1
                            for s, weights in enumerate((wy, ww, None)):
                                out[s, j] += np.bincount(slot, weights, width)
            for t, (_, ids) in wanted.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), t), pa.int32()), pa.array(ids, pa.int32()), pa.array([s.tobytes() for s in total[t]], pa.binary())],
                    names=["tree", "node", "sums"])

        def splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            for batch in batches:
                for t, k, s in zip(*(c.to_pylist() for c in batch.columns)):
                    held[t, k] = held[t, k] + np.frombuffer(s) if (t, k) in held else np.frombuffer(s)
            for (t, k), s in held.items():
                feats, s = choose(seed, t, [k], n, per_split), s.reshape(3, 1, per_split, width)
                split = best(s[:2], feats)[0]
                rows = s[2, 0, int((feats[0] == split[0]).argmax())]
                left = rows[:int(split[1]) + 1].sum() + (rows[-1] if split[2] else 0)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([k], pa.int32()),
                                                  pa.array([[*split.tolist(), left, rows.sum() - left]], pa.list_(pa.float64()))],
                                                 names=["tree", "node", "split"])

        met = data.mapInArrow(sums, "tree int, node int, sums binary").repartition(min(spread, step), "tree", "node")
        for r in met.mapInArrow(splits, "tree int, node int, split array<double>").collect():  # a row per node
            f, cut, miss, gain, gl, hl, g, h, left, right = r["split"]
            tree, k = model.trees[r["tree"]], r["node"]
            tree.weight[k] = g / h
            if f >= 0:
                tree.feature[k], tree.cut[k], tree.missing_left[k], tree.gain[k] = f, cut, miss, gain
                tree.weight[2 * k + 1], tree.weight[2 * k + 2] = gl / hl, (g - gl) / (h - hl)
                children |= {(r["tree"], 2 * k + 1): int(left), (r["tree"], 2 * k + 2): int(right)}
    return children


def _finish_small(data: DataFrame, model: ForestModel, nodes: list[tuple[int, int]], n: int, job: tuple) -> None:
    """Each node's rows go to one task, which grows what is below it."""
    seed, depth, per_split, width = job
    if not nodes:
        return
    blocks, seen = _reader(n, seed)
    *_, finish = _growing()
    import numpy as np
    import pyarrow as pa

    wanted = _by_tree(model, nodes)

    def hand_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block, b, y, w in blocks(batches):
            for t, (arrays, ids) in wanted.items():
                # A feature's bytes side by side: they pack well.
                out = [(t, int(ids[i]), block, part, len(rows), b[:, rows].tobytes(), y[rows].tobytes(), (c * w[rows]).tobytes())
                       for i, rows, c in seen(part, block, b, t, arrays, ids)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                        names=["tree", "node", "block", "part", "m", "bins", "y", "w"])

    def subtree(group: pa.Table) -> pa.Table:
        # In one order whatever task came first, so sums agree between runs.
        group = group.sort_by([("part", "ascending"), ("block", "ascending")])
        t, root = group["tree"][0].as_py(), group["node"][0].as_py()
        b = np.concatenate([np.frombuffer(s, np.uint8).reshape(n, -1).T for s in group["bins"].to_pylist()])
        y, w = (np.frombuffer(b"".join(group[c].to_pylist())) for c in ("y", "w"))
        out = finish(b, y, w, seed, t, root, (root + 1).bit_length() - 1, depth, per_split, width)
        return pa.table({"tree": pa.array([t], pa.int32()), "nodes": pa.array([out.tobytes()], pa.binary())})

    handed = data.mapInArrow(hand_on, "tree int, node int, block long, part int, m long, bins binary, y binary, w binary")
    done = handed.groupBy("tree", "node").applyInArrow(subtree, "tree int, nodes binary")
    for r in done.collect():  # the model's nodes
        s, tree = np.frombuffer(r["nodes"]).reshape(-1, 6), model.trees[r["tree"]]
        at = s[:, 0].astype(int)
        tree.feature[at], tree.cut[at], tree.missing_left[at], tree.weight[at], tree.gain[at] = s[:, 1], s[:, 2], s[:, 3] > 0, s[:, 4], s[:, 5]
