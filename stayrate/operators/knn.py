"""Exact k-nearest-neighbour self-join, by pivots and the triangle inequality.

Rows go to the cell of their nearest pivot (pivots are a bounded sample).  Each row is
first compared with its own cell; its k-th distance there is an upper bound, and only
cells that may hold something closer are searched after that: with pivots p (own) and
q, no row of q's cell lies closer to x than |x q| - radius(q), nor than
(|x q|^2 - |x p|^2) / (2 |p q|), the distance to the plane between the cells.

A cell is dealt out in blocks of at most ``BLOCK`` rows, so a large one is many tasks;
a block's rows stand in memory and the visiting rows stream past it, compared as one
matrix product.  What leaves a block is k rows per visitor, never all pairs.  Equal vectors are
one visitor and as many targets as can be wanted, so copies do not meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.session import cut_lineage

#: Pivots at most: with the vector length they bound what the driver and each task hold.
MAX_PIVOTS = 2_048
#: Rows of a block, and rows compared with it at a time.
BLOCK = 2_048
PROBES = 512


def knn_join(rows: DataFrame, k: int = 5) -> tuple[DataFrame, float]:
    """(key, rank, neighbour, nv, distance) of the ``k`` nearest other rows of each row
    (key, v), and the comparisons made per different vector.

    Ties go to the smaller key.  Keys are unique; vectors are arrays of doubles of one
    length without nulls.
    """
    order = Window.partitionBy("v").orderBy("key")
    # Equal vectors are equally far from all: the first k + 1 stand for them (limited before the shuffle).
    targets = cut_lineage(rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
                          .withColumn("id", F.monotonically_increasing_id()))
    distinct = targets.where("nth = 1")
    n = distinct.count()
    if n == 0:
        empty = rows.select("key", F.lit(0).alias("rank"), F.col("key").alias("neighbour"), F.col("v").alias("nv"), F.lit(0.0).alias("distance"))
        return empty.where(F.lit(False)), 0.0
    pivots = _pivots(distinct, n)
    placed = cut_lineage(_place(targets, pivots))
    cells = {r["cell"]: (r["n"], r["radius"]) for r in
             placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius")).collect()}  # a row per pivot

    own = placed.where("nth = 1").select("id", "v", "d", F.array("cell").alias("cells"))
    first = cut_lineage(_best(_compare(placed, own, cells, k + 1), k + 1))
    bounds = first.where(F.col("rank") == k + 1).select(F.col("probe"), F.col("distance").alias("bound"))
    rest = placed.where("nth = 1").join(bounds, F.col("id") == F.col("probe"), "left").select(
        "id", "v", "d", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    rest = cut_lineage(_reach(rest, pivots, cells))
    second = _compare(placed, rest, cells, k + 1)
    found = cut_lineage(_best(first.drop("rank").unionByName(second), k + 1))

    size = F.create_map(*[x for c, (m, _) in cells.items() for x in (F.lit(c), F.lit(m))]) if len(cells) <= 64 else None
    met = own.select(F.explode("cells").alias("cell")).unionByName(rest.select(F.explode("cells").alias("cell")))
    if size is not None:
        compared = met.agg(F.sum(size[F.col("cell")])).first()[0]
    else:
        sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        compared = met.groupBy("cell").agg(F.count(F.lit(1)).alias("times")).join(sizes, "cell").agg(F.sum(F.col("times") * F.col("n"))).first()[0]

    of = targets.select(F.col("id").alias("tid"), F.col("key").alias("neighbour"), F.col("v").alias("nv"))
    named = found.join(of, F.col("target") == F.col("tid")).select("probe", "neighbour", "nv", "distance")
    probes = distinct.select(F.col("id").alias("pid"), F.col("v").alias("pv"))
    each = rows.join(probes, F.col("v") == F.col("pv")).select("key", "pid")
    mine = each.join(named, F.col("pid") == F.col("probe")).where("neighbour <> key")
    ranked = mine.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("distance", "neighbour")))
    return ranked.where(F.col("rank") <= k).select("key", "rank", "neighbour", "nv", "distance"), compared / n


def _pivots(distinct: DataFrame, n: int):
    """About the square root of the rows as a matrix, chosen by hash; the same rows on any partitioning."""
    import numpy as np

    wanted = max(1, min(MAX_PIVOTS, round(n ** 0.5)))
    share = max(1, n // wanted)
    got = distinct.where(F.pmod(F.xxhash64("v"), F.lit(share)) == 0).select("v").limit(4 * MAX_PIVOTS).collect()
    x = np.array([r["v"] for r in got] or [distinct.first()["v"]], float)
    return x[np.lexsort(x.T[::-1])][:MAX_PIVOTS]


def _place(rows: DataFrame, pivots) -> DataFrame:
    """Adds each row's cell and its distance ``d`` from the pivot."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (pivots * pivots).sum(axis=1) / 2
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                b = batch.slice(lo, 1024)
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                cell = (x @ pivots.T - half).argmax(axis=1)
                d = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d)], names=[*b.schema.names, "cell", "d"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, cell long, d double")


def _reach(probes: DataFrame, pivots, cells: dict) -> DataFrame:
    """(id, v, cells): the other cells that may hold a row within ``bound`` of each probe."""
    import numpy as np
    import pyarrow as pa

    radius = np.array([cells.get(c, (0, -np.inf))[1] for c in range(len(pivots))])
    apart = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None]) ** 2).sum(axis=2), 0)) if len(pivots) <= 256 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                own, bound = b.column("cell").to_numpy(), b.column("bound").to_numpy()[:, None]
                norm = (x * x).sum(axis=1)[:, None]
                d2 = np.maximum(norm - 2 * x @ pivots.T + (pivots * pivots).sum(axis=1), 0)
                between = apart[own] if apart is not None else np.sqrt(np.maximum(
                    (pivots[own] ** 2).sum(axis=1)[:, None] - 2 * pivots[own] @ pivots.T + (pivots * pivots).sum(axis=1), 0))
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = np.where(between > 0, (d2 - np.take_along_axis(d2, own[:, None], 1)) / (2 * between), 0.0)
                low = np.maximum(np.sqrt(d2) - radius, plane)
                slack = 1e-7 * (1 + np.sqrt(norm) + np.sqrt(d2))  # above the rounding of the products
                near = low <= bound + slack
                near[np.arange(len(own)), own] = False
                near[:, ~np.isfinite(radius)] = False
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("v"), pa.array([np.flatnonzero(r).tolist() for r in near], pa.list_(pa.int64()))],
                    names=["id", "v", "cells"])

    return probes.mapInArrow(run, "id long, v array<double>, cells array<long>")


def _compare(placed: DataFrame, probes: DataFrame, cells: dict, k: int) -> DataFrame:
    """(probe, target, key, distance): the ``k`` nearest rows of each block that a probe visits."""
    import numpy as np
    import pyarrow as pa

    probe_rows = PROBES
    n_parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = {c: -(-n // BLOCK) for c, (n, _) in cells.items() if n > BLOCK}  # a number per pivot at most
    blocks = F.coalesce(F.create_map(*[x for c, b in hot.items() for x in (F.lit(c), F.lit(b))])[F.col("cell")], F.lit(1)) if hot else F.lit(1)
    key_type = placed.schema["key"].dataType.simpleString()
    home = placed.select("cell", F.pmod(F.xxhash64("id"), blocks).cast("long").alias("block"), F.lit(0).alias("kind"), "id", "key", "v")
    visit = probes.select(F.explode("cells").alias("cell"), "id", "v").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)).alias("block"), F.lit(1).alias("kind"), "id",
        F.lit(None).cast(key_type).alias("key"), "v")
    dealt = home.unionByName(visit).repartition(n_parts, "cell", "block").sortWithinPartitions("cell", "block", "kind", "key")

    def best(x, ids, keys, probe, a):
        rough = (x * x).sum(axis=1)[None, :] - 2 * a @ x.T + (a * a).sum(axis=1)[:, None]
        if x.shape[0] > k:
            slack = 1e-10 * ((a * a).sum(axis=1) + (x * x).sum(axis=1).max())
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
            r, c = np.nonzero(rough <= limit[:, None])
        else:
            r, c = np.divmod(np.arange(rough.size), x.shape[0])
        d = np.sqrt(((a[r] - x[c]) ** 2).sum(axis=1))
        order = np.lexsort((c, d, r))  # rows of a block stand in the order of their keys
        r, c, d = r[order], c[order], d[order]
        start = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        keep = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r)))) < k
        return pa.RecordBatch.from_arrays([pa.array(probe[r[keep]]), pa.array(ids[c[keep]]), keys.take(pa.array(c[keep])), pa.array(d[keep])],
                                          names=["probe", "target", "key", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            cell, part = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            edge = (np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1).tolist() if len(cell) else []
            for lo, hi in zip([0, *edge], [*edge, len(cell)]):
                if lo == hi:
                    continue
                if at != (cell[lo], part[lo]):
                    at, parts, block = (cell[lo], part[lo]), [], None
                b = batch.slice(lo, hi - lo)
                n_home = int(np.searchsorted(b.column("kind").to_numpy(), 1))
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                ids = b.column("id").to_numpy()
                if n_home:
                    parts.append((x[:n_home], ids[:n_home], b.column("key").slice(0, n_home)))
                if n_home < b.num_rows and parts:
                    if block is None:
                        block = (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                                 pa.concat_arrays([p[2] for p in parts]))
                    for s in range(n_home, b.num_rows, probe_rows):
                        e = min(s + probe_rows, b.num_rows)
                        yield best(*block, ids[s:e], x[s:e])

    return dealt.mapInArrow(run, f"probe long, target long, key {key_type}, distance double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("probe").orderBy("distance", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
