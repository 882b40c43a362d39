"""Many K-Means models in one pass against separate fits and plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from stayrate.operators import kmeans as km
from stayrate.operators import segments as sg


def blobs(n=900, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 6, (5, 3))[rng.integers(0, 5, n)] + rng.normal(0, 1, (n, 3))


def frame(spark, x, parts=4):
    return spark.createDataFrame([([float(a) for a in r],) for r in x], "x array<double>").repartition(parts).cache()


def lloyd(x, c, tol=1e-4):
    for n in range(300):
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == k].mean(axis=0) if (near == k).any() else c[k] for k in range(len(c))])
        moved = ((new - c) ** 2).sum(axis=1).max()
        c = new
        if moved <= tol * tol:
            break
    return ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum(), n + 1


def test_models_together_equal_models_apart_and_numpy(spark, monkeypatch):
    x = blobs()
    df = frame(spark, x)
    models = [(k, s) for k in (2, 3, 5) for s in (7, 8)]
    passes = []
    plain = km.one_pass
    monkeypatch.setattr(km, "one_pass", lambda rows, runs: passes.append(len(runs)) or plain(rows, runs))
    runs = km.fit_many(df, models)
    assert [(r.k, r.seed) for r in runs] == models
    assert len(passes) == max(r.iterations for r in runs) + 1  # one job per iteration, and the inertia
    assert passes[0] == 6 and passes[-2] < 6                    # models that stand still leave
    order = x[np.lexsort(x.T[::-1])]
    for r in runs:
        alone = km.fit_many(df, [(r.k, r.seed)])[0]
        assert alone.inertia == pytest.approx(r.inertia, rel=1e-9)
        want, steps = lloyd(x, km.first_centroids(order, r.k, r.seed))
        assert r.inertia == pytest.approx(want, rel=1e-6) and r.iterations == steps


def test_elbow_falls_and_best_run_is_least(spark):
    x = blobs(400, 3)
    scaled = spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "customer_id int, a double, b double, c double")
    got = {r.k: r.inertia for r in sg.elbow(scaled, range(2, 7), n_init=4, cols=["a", "b", "c"]).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6] and all(got[k] > got[k + 1] for k in range(2, 5))
    vec = sg._vectors(scaled, ["a", "b", "c"])
    assert sg.kmeans_best(vec, 4, n_init=4).inertia == pytest.approx(got[4])


def test_awkward_rows(spark):
    same = frame(spark, [[1.0, 2.0]] * 20)
    run = km.fit_many(same, [(3, 1)])[0]
    assert run.inertia == 0 and run.centroids.tolist() == [[1.0, 2.0]] * 3
    assert km.fit_many(same.limit(0), [(2, 1)]) == []
    nulls = same.union(spark.createDataFrame([(None,)], "x array<double>"))
    assert km.fit_many(nulls, [(1, 1)])[0].centroids.tolist() == [[1.0, 2.0]]


def test_registered_elbow(spark):
    from stayrate.plans import QUERIES
    rows = QUERIES["elbow"](spark, SMALL).orderBy("k").collect()
    assert [r.k for r in rows] == list(range(2, 11))
    assert all(b.inertia <= a.inertia * 1.001 for a, b in zip(rows, rows[1:]))
    seg = QUERIES["kmeans_segments"](spark, SMALL)
    assert seg.select(F.countDistinct("segment")).first()[0] == 4


def test_models_settle_on_the_drawn_rows_first(spark, monkeypatch):
    """Few passes over all rows are left, and each ends where no centroid moves over all rows."""
    monkeypatch.setattr(km, "SAMPLE", 1_000)
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (12_000, 3)) * [3, 2, 1]  # no groups: Lloyd's algorithm goes a long way
    df = frame(spark, x)
    models = [(k, s) for k in (4, 6) for s in (1, 2)]
    runs = km.fit_many(df, models)
    monkeypatch.setattr(km, "settled", lambda spark, x, starts, *a: starts)
    far = km.fit_many(df, models)
    assert sum(r.iterations for r in runs) < 0.8 * sum(r.iterations for r in far)
    for r, f in zip(runs, far):
        cost, steps = lloyd(x, r.centroids)
        assert steps <= 2 and r.inertia == pytest.approx(cost, rel=1e-6)
        assert r.inertia < 1.1 * f.inertia
