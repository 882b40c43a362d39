"""Hard negatives and nearest neighbours against brute force and on awkward tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from stayrate.llm import cells, learned_partitions, negatives, queries

#: Columns named like the operators' own.
CLASH = ["c", "cell", "slab", "kind", "id", "slot", "score", "extra", "cells", "rank", "v2", "nth", "low", "cut"]


def frame(spark, rows, vector="v"):
    df = spark.createDataFrame(rows, f"vec_id long, {vector} array<double>, label int")
    return df.withColumns({c: F.lit(k) for k, c in enumerate(CLASH)})


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


# -- 11 hard negatives ----------------------------------------------------------------
def brute_negatives(rows, every, n_pos=5, n_neg=5):
    rows = list(dict.fromkeys((k, tuple(v), lab) for k, v, lab in rows if k is not None and lab is not None and good(v)))
    out = []
    for a in rows:
        if a[0] % every:
            continue
        score = lambda r, a=a: int(np.dot(a[1], r[1]))
        other = [r for r in rows if r != a and len(r[1]) == len(a[1])]
        best = lambda rs: sorted(rs, key=lambda r: (-score(r), r[0]))
        for p in best([r for r in other if r[2] == a[2]])[:n_pos]:
            ps = score(p)
            inside = [r for r in other if r[2] != a[2] and 80 * ps <= 100 * score(r) <= 100 * ps]
            out += [(a[0], p[0], k + 1, n[0], ps, score(n)) for k, n in enumerate(best(inside)[:n_neg])]
    return sorted(out)


def mined(df, every):
    got = negatives.hard_negatives(df, F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def integer_rows(n, dim, seed, spread=40):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 60, (6, dim))
    x = np.floor(centre[rng.integers(0, 6, n)] + rng.normal(0, spread, (n, dim)))
    return [(k, v.tolist(), int(lab)) for k, (v, lab) in enumerate(zip(x, rng.integers(0, 4, n)))]


def test_multi_sequence_hands_out_every_cell_by_falling_sum():
    rng = np.random.default_rng(1)
    u, w = rng.integers(0, 5, 13).astype(float), rng.normal(size=9)
    got = list(negatives.multi_sequence(u, w))
    assert len({(i, j) for _, i, j in got}) == 13 * 9
    assert all(abs(s - u[i] - w[j]) < 1e-12 for s, i, j in got)
    assert all(a[0] >= b[0] - 1e-12 for a, b in zip(got, got[1:]))


def test_bounds_hold_for_every_vector_of_a_cell():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 50, (800, 9)).round()
    books = negatives.kmeans(x[:, :4], 6), negatives.kmeans(x[:, 4:], 6)
    index = negatives.MultiIndex(9, books)
    i, j, ri, rj = index.place(x)
    radii = [np.array([r[w == k].max(initial=-1) for k in range(6)]) for w, r in ((i, ri), (j, rj))]
    index = negatives.MultiIndex(9, books, tuple(radii))
    for a in x[:20]:
        score, seen, skip = x @ a, [], 0
        while True:  # in rounds of seven cells
            got, bound = index.cells_of(a, skip, 7, -np.inf)
            seen += got
            skip += len(got)
            rest = ~np.isin(i * 6 + j, seen)
            assert not rest.any() or score[rest].max() <= bound
            if bound == -np.inf:
                break
        assert set(seen) >= set((i * 6 + j).tolist()) and len(seen) == len(set(seen))


@pytest.mark.parametrize("first", [2, 64])
def test_negatives_against_brute_force(spark, monkeypatch, first):
    monkeypatch.setattr(negatives, "FIRST_CELLS", first)
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    rows = integer_rows(700, 6, 3)
    want = brute_negatives(rows, 9)
    assert len(want) > 500 and {r[2] for r in want} == {1, 2, 3, 4, 5}
    assert mined(frame(spark, rows), 9) == want
    assert mined(frame(spark, rows).repartition(5), 9) == want


def test_search_stops_early_where_bounds_allow(spark, monkeypatch):
    """Tight clusters: certified windows leave most cells unvisited."""
    monkeypatch.setattr(negatives, "FIRST_CELLS", 4)
    monkeypatch.setattr(negatives, "LONGER", 2)
    monkeypatch.setattr(negatives, "CELL_ROWS", 4)
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 200, (60, 8))
    rows = [(k, np.floor(centre[k % 60] + rng.normal(0, 2, 8)).tolist(), int(k % 7 == 0)) for k in range(1200)]
    visited = []
    plain = cells.dealt_queries

    def counted(queries_, out):
        visited.append(queries_.agg(F.sum(F.size("cells"))).first()[0])
        return plain(queries_, out)

    monkeypatch.setattr(cells, "dealt_queries", counted)
    want = brute_negatives(rows, 40)
    assert mined(frame(spark, rows), 40) == want and want
    k = round((len(rows) / 4) ** 0.5)
    assert sum(visited) < 0.5 * 2 * 30 * k * k  # of two searches of 30 anchors over k * k cells


def test_negatives_of_awkward_tables(spark):
    rows = integer_rows(150, 4, 7)
    same = [5.0, 5.0, 1.0, 0.0]
    rows += [(1000 + k, same, k % 2) for k in range(120)]                  # a hot group of equal vectors, anchors among them
    rows += [(2000, same, 0), (2000, same, 0), (2000, [9.0, 1.0, 0.0, 0.0], 0), (2000, same, 1)]  # repeated ids
    rows += [(None, same, 0), (3000, None, 0), (3001, same, None), (3002, [1.0, None, 0.0, 0.0], 0), (3003, [float("nan")] * 4, 0),
             (3010, [float("inf"), 0.0, 0.0, 0.0], 0), (3020, [], 0), (3030, [0.0] * 4, 0), (3040, [0.0] * 4, 1),
             (4000, [1.0, 2.0], 0), (4001, [2.0, 2.0], 0), (4002, [1.0, 2.0], 1), (4010, [3.0] * 7, 0), (-10, same, 1)]
    want = brute_negatives(rows, 10)
    assert {1000, 2000, 4000, -10} <= {r[0] for r in want}
    assert mined(frame(spark, rows), 10) == want
    assert mined(frame(spark, rows).limit(0), 10) == []
    assert mined(frame(spark, [(0, [1.0], 1)]), 10) == []


def test_registered_negatives_take_no_part_of_bad_rows(spark, tmp_path):
    rows = [(k, [float(np.float32(x)) for x in np.random.default_rng(k).normal(0, 0.3, 5)], k % 3) for k in range(300)]
    rows += [(700, None, 1), (800, [None] * 5, 1), (900, [0.1] * 5, None), (None, [0.1] * 5, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in queries.QUERIES["op11_hard_negatives"](spark, str(tmp_path)).collect())
    kept = [(k, None if v is None else [None if x is None else float(np.floor(256 * float(np.float32(x)))) for x in v],
             None if lab is None else ((lab + 1) % 10 if k is not None and k % 7 == 0 else lab)) for k, v, lab in rows]
    assert got == brute_negatives(kept, 100) and got


# -- 12 nearest neighbours --------------------------------------------------------------
def brute_nearest(rows, every, k=10):
    rows = list(dict.fromkeys((i, tuple(v)) for i, v, _ in rows if i is not None and good(v) and any(v)))
    out = {}
    for q in rows:
        if q[0] % every == 0:
            other = [(float(np.sqrt(((np.array(q[1]) - np.array(r[1])) ** 2).sum())), r[0]) for r in rows
                     if r != q and len(r[1]) == len(q[1])]
            out.setdefault(q[0], []).append(sorted(other)[:k])
    return out


def nearest(df, every, **kw):
    got = learned_partitions.nearest_neighbours(df, F.col("vec_id") % every == 0, vector_col="v", **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in sorted(got.collect()):
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return out


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 5, (16, 8))[rng.integers(0, 16, 1500)] + rng.normal(0, 1, (1500, 8))
    near = learned_partitions.nearest_ids(x, x, 10, True)
    brute = np.argsort(((x[:40, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, 1:11]
    assert all(set(a) == set(b) for a, b in zip(near[:40], brute))
    part = learned_partitions.balanced_parts(x, near, 8)
    assert np.bincount(part, minlength=8).min() >= 187 and np.bincount(part).max() <= 188
    assert (part[near] == part[:, None]).mean() > 0.7  # at random it would be an eighth


def test_recall_on_clustered_vectors_with_few_visits(spark, monkeypatch):
    monkeypatch.setattr(learned_partitions, "PART_ROWS", 64)
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (40, 12))[rng.integers(0, 40, 3000)] + rng.normal(0, 0.3, (3000, 12))
    rows = [(k, v.tolist(), None) for k, v in enumerate(x)]
    want, got = brute_nearest(rows, 50), nearest(frame(spark, rows), 50)
    assert set(got) == set(want)
    found = sum(len({i for _, _, i in got[q]} & {i for _, i in want[q][0]}) for q in want) / (10 * len(want))
    assert found >= 0.9
    for q, best in got.items():
        assert [r for r, _, _ in best] == list(range(1, 11)) and [s for _, s, _ in best] == sorted(s for _, s, _ in best)
        assert all(s == pytest.approx(float(np.linalg.norm(x[q] - x[i])), rel=1e-13) for _, s, i in best)
    router = learned_partitions.fit_router(x, len(x), 0.97, 10)
    assert router.parts >= 16 and np.mean([len(v) for v in router.visits(x)]) < 0.4 * router.parts


def test_small_tables_are_searched_whole(spark):
    """Below two parts the search is exact: ties, repeated rows, odd lengths and hot copies."""
    rng = np.random.default_rng(8)
    rows = [(k, rng.integers(-2, 3, 3).astype(float).tolist(), None) for k in range(200)]
    same = [7.0, 7.0, 7.0]
    rows += [(1000 + k, same, 1) for k in range(100)] + [(2000, same, None), (2000, same, None), (2000, [1.0, 0.0, 0.0], None)]
    rows += [(None, same, 1), (3000, None, 1), (3010, [], 1), (3020, [0.0] * 3, 1), (3030, [None, 1.0, 1.0], 1),
             (3040, [float("nan"), 1.0, 1.0], 1), (3050, [float("-inf"), 1.0, 1.0], 1), (4000, [1.0, 2.0], 1), (4001, [1.0, 2.0], 1),
             (4010, [3.0] * 5, 1)]
    want = brute_nearest(rows, 10)
    got = nearest(frame(spark, rows), 10)
    assert set(got) == {q for q, lists in want.items() if any(lists)} and 4010 not in got and 4000 in got
    for q, lists in want.items():
        if q != 2000:
            assert [(s, i) for _, s, i in got.get(q, [])] == [(pytest.approx(s), i) for s, i in lists[0]]
    assert sorted((round(s, 9), i) for _, s, i in got[2000]) == sorted((round(s, 9), i) for part in want[2000] for s, i in part)
    assert nearest(frame(spark, rows).limit(0), 10) == {}
    assert nearest(frame(spark, [(0, [1.0], 1)]), 10) == {}


def test_hot_cells_are_cut_into_blocks(spark):
    placed = spark.range(40_000).select((F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000 + 10)).alias("cell"),
                                        F.col("id").alias("vec_id"), F.lit(None).cast("long").alias("label"),
                                        F.array(F.col("id").cast("double")).alias("v"))
    out = cells.layout(placed, 40_000)
    rows = cells.dealt_rows(placed, out).groupBy("slab").count().collect()
    assert sum(r["count"] for r in rows) == 40_000
    assert max(r["count"] for r in rows) < 3 * 40_000 / out.slabs
    slab, cell = out.visits(np.array([5, 77]))
    assert {5, 77} == set(cell.tolist()) and len(set(slab[cell == 5].tolist())) > out.slabs / 5
    homes = cells.dealt_rows(placed, out).where("cell IN (5, 77)").select("slab", "cell").distinct().collect()
    assert {(r["slab"], r["cell"]) for r in homes} <= set(zip(slab.tolist(), cell.tolist()))


def test_registered_nearest(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], None) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    want = brute_nearest(rows, 100)
    got = {}
    for r in sorted(queries.QUERIES["op12_nearest_neighbours"](spark, MEDIUM).collect()):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for _, i in lists[0]] for q, lists in want.items()}
