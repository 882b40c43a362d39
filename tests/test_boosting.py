"""Histogram boosting against a small brute-force booster."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from stayrate.operators import boosting
from stayrate.operators import models as mo


def brute_fit(x, y, w, cuts, objective, n_trees, depth, rate=0.1, lam=1.0, least=1.0):
    """Margins of the training rows after each tree, by trying every split of every node on the rows themselves."""
    mean = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.log(mean / (1 - mean)) if objective == "logistic" else mean)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (w * (p - y), w * p * (1 - p)) if objective == "logistic" else (w * (margin - y), w)
        nodes, step = [np.arange(len(y))], np.zeros(len(y))
        step[:] = -g.sum() / (h.sum() + lam)
        for _ in range(depth):
            after = []
            for rows in nodes:
                best, score = None, 1e-12
                total = g[rows].sum() ** 2 / (h[rows].sum() + lam)
                for f in range(x.shape[1]):
                    v = x[rows, f]
                    for c in cuts[f]:
                        for miss in (False, True):
                            left = (v <= c) | (np.isnan(v) & miss)
                            a, b = rows[left], rows[~left]
                            if h[a].sum() < least or h[b].sum() < least:
                                continue
                            gain = 0.5 * (g[a].sum() ** 2 / (h[a].sum() + lam) + g[b].sum() ** 2 / (h[b].sum() + lam) - total)
                            if gain > score * (1 + 1e-9):
                                best, score = (a, b), gain
                if best:
                    for part in best:
                        step[part] = -g[part].sum() / (h[part].sum() + lam)
                    after += best
            nodes = after
        margin = margin + rate * step
    return margin


def data(n=240, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 1, (n, 4)), 1)
    x[rng.random(n) < 0.2, 1] = np.nan
    x[:, 3] = 1.0  # a constant column splits nothing
    signal = x[:, 0] * 2 + np.where(np.isnan(x[:, 1]), 1.5, x[:, 1] ** 2)
    return x, signal, rng.uniform(0.5, 2, n)


def frame(spark, x, y, w, parts=4):
    rows = [(k, Vectors.dense(v), float(a) if a is not None else None, float(b)) for k, (v, a, b) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, ["k", "features", "y", "w"]).repartition(parts)


@pytest.mark.parametrize("objective, direct", [("squared", 64 << 20), ("squared", 0), ("logistic", 0)])
def test_equals_a_brute_force_booster(spark, monkeypatch, objective, direct):
    monkeypatch.setattr(boosting, "DIRECT_BYTES", direct)  # 0: histograms are shuffled
    monkeypatch.setattr(boosting, "TREES_PER_CHECKPOINT", 3)
    x, signal, w = data()
    y = (signal > 1).astype(float) if objective == "logistic" else signal
    df = frame(spark, x, y, w)
    model = boosting.fit_boosted(df, "y", weight="w", objective=objective, n_trees=5, depth=3, rate=0.3, bins=8)
    assert len(model.trees) == 5 and all(len(c) <= 7 for c in model.cuts)
    want = brute_fit(x, y, w, model.cuts, objective, 5, 3, rate=0.3)
    assert np.allclose(model.margins(x), want, atol=1e-9)
    got = {r["k"]: r for r in model.transform(df).collect()}
    for k in range(len(x)):
        if objective == "logistic":
            assert got[k]["probability"] == pytest.approx(1 / (1 + np.exp(-want[k]))) and got[k]["prediction"] == (want[k] >= 0)
        else:
            assert got[k]["prediction"] == pytest.approx(want[k], abs=1e-9)
    again = boosting.BoostedModel.from_json(model.to_json())
    assert np.array_equal(again.margins(x), model.margins(x))
    share = model.importances()
    assert share.sum() == pytest.approx(1) and share[3] == 0 and share[0] > 0


def test_learns_and_stops(spark):
    x, signal, w = data(600, 2)
    df = frame(spark, x, signal, w)
    model = boosting.fit_boosted(df, "y", n_trees=40, depth=4, rate=0.3)
    assert np.mean((model.margins(x) - signal) ** 2) < 0.02 * np.var(signal)
    flat = boosting.fit_boosted(frame(spark, x, np.full(len(x), 3.0), w), "y", n_trees=10)
    assert len(flat.trees) == 1 and np.allclose(flat.margins(x), 3.0)


def test_awkward_rows(spark):
    x, signal, w = data(50, 3)
    y = [None if k % 7 == 0 else float(v) for k, v in enumerate(signal)]
    keep = np.array([v is not None for v in y])
    a = boosting.fit_boosted(frame(spark, x, y, w), "y", n_trees=2, depth=2, bins=4)
    b = boosting.fit_boosted(frame(spark, x[keep], signal[keep], w[keep], 2), "y", n_trees=2, depth=2, bins=4)
    assert np.allclose(a.margins(x), b.margins(x))
    none = boosting.fit_boosted(frame(spark, x, signal, w).limit(0), "y", n_trees=2)
    assert none.trees == [] and none.base == 0.0


def brute_first_order(x, y, w, cuts, deviance, n_trees, depth, rate):
    """Margins of gradient boosting: splits by squared error of the residuals, Newton leaves for the deviance."""
    mean = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.log(mean / (1 - mean)) if deviance else mean)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin)) if deviance else margin
        r, h = y - p, w * p * (1 - p) if deviance else w
        leaves = [np.arange(len(y))]
        for _ in range(depth):
            after = []
            for rows in leaves:
                fit = lambda s: (w[s] * r[s]).sum() ** 2 / w[s].sum() if len(s) else -np.inf
                best, score = None, 1e-9
                for f in range(x.shape[1]):
                    v = x[rows, f]
                    for c in cuts[f]:
                        for miss in (False, True):
                            left = (v <= c) | (np.isnan(v) & miss)
                            gain = 0.5 * (fit(rows[left]) + fit(rows[~left]) - fit(rows))
                            if gain > score * (1 + 1e-9):
                                best, score = (rows[left], rows[~left]), gain
                after += best or [rows]
            leaves = after
        step = np.zeros(len(y))
        for rows in leaves:
            step[rows] = (w[rows] * r[rows]).sum() / h[rows].sum()
        margin = margin + rate * step
    return margin


@pytest.mark.parametrize("deviance, direct", [(False, 64 << 20), (True, 64 << 20), (True, 0)])
def test_gradient_boosting_equals_brute_force(spark, monkeypatch, deviance, direct):
    monkeypatch.setattr(boosting, "DIRECT_BYTES", direct)
    x, signal, w = data(160, 5)
    y = (signal + np.random.default_rng(6).normal(0, 1, len(signal)) > 1).astype(float) if deviance else signal
    df = frame(spark, x, y, w).withColumnsRenamed({"y": mo.TARGET, "w": mo.WEIGHT})
    monkeypatch.setattr(mo, "GBT_BINS", 8)
    if deviance:
        model, weights = mo.GBTClassifier(3, 4, 0.3, mo.WEIGHT).fit(df), w
    else:
        model, weights = mo.GBTRegressor(3, 4, 0.3).fit(df), np.ones(len(w))
    want = brute_first_order(x, y, weights, model.cuts, deviance, 4, 3, 0.3)
    assert np.allclose(model.margins(x), want, atol=1e-9)
    assert model.importances().sum() == pytest.approx(1)
    got = {r["k"]: r for r in model.transform(df).collect()}
    for k in range(len(x)):
        assert got[k]["probability" if deviance else "prediction"] == pytest.approx(1 / (1 + np.exp(-want[k])) if deviance else want[k])
    again = boosting.GradientBoostedModel.from_json(model.to_json())
    assert np.array_equal(again.margins(x), model.margins(x))


def test_of_two_children_only_the_lighter_is_counted(spark, monkeypatch):
    counted, real = [], boosting._level

    def level(data, tasks, model, tree, nodes, light, above, *rest):
        counted.append((len(nodes), len(light) if above else len(nodes)))
        return real(data, tasks, model, tree, nodes, light, above, *rest)

    monkeypatch.setattr(boosting, "_level", level)
    x, signal, w = data()
    boosting.fit_boosted(frame(spark, x, signal, w), "y", n_trees=2, depth=4)
    assert all(c == (n + 1) // 2 for n, c in counted) and max(n for n, _ in counted) > 4


def test_a_fit_plans_its_rows_once(spark, monkeypatch):
    """The passes of the trees are jobs over cached blocks; only the binning is a query."""
    planned, real = [], type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda df, *a, **k: planned.append(1) or real(df, *a, **k))
    x, signal, w = data()
    model = boosting.fit_boosted(frame(spark, x, signal, w), "y", n_trees=4, depth=3)
    assert len(model.trees) == 4 and len(planned) == 1


def test_cuts_are_asked_for_in_few_calls(spark, monkeypatch):
    rows = spark.createDataFrame([([float(k * j % 101) for j in range(40)],) for k in range(500)], "x array<double>")
    client, calls = spark._jvm._gateway_client, []
    real = client.send_command
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or real(*a, **k))
    cuts = boosting.quantile_cuts(rows, 40, 64)
    assert len(cuts) == 40 and len(cuts[0]) == 1 and len(calls) < 1000


def test_features_are_counted_in_groups(spark, monkeypatch):
    """Narrow features share a code; sums of a group give each feature's, with missing values and bins not in use."""
    seen, real = [], boosting._groups
    monkeypatch.setattr(boosting, "_groups", lambda *a: seen.append(real(*a)) or seen[-1])
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.integers(0, 2, (300, 20)), rng.normal(0, 1, (300, 2))]).astype(float)
    x[rng.random(300) < 0.3, 4] = np.nan
    y = x[:, 0] + 2 * x[:, 7] * x[:, 20] + np.where(np.isnan(x[:, 4]), 3, x[:, 4])
    model = boosting.fit_boosted(frame(spark, x, y, np.ones(300)), "y", n_trees=4, depth=3, rate=0.3, bins=8)
    assert len(seen[0]) <= 6 and sorted(f for g in seen[0] for f in g) == list(range(22))
    assert np.allclose(model.margins(x), brute_fit(x, y, np.ones(300), model.cuts, "squared", 4, 3, rate=0.3), atol=1e-9)


def test_groups_stay_within_their_cells():
    wide = boosting._groups([np.arange(64)] * 9 + [np.arange(2)] * 40, 10 ** 6, 5)
    assert all(np.prod([64 if f < 9 else 2 for f in g]) <= boosting.JOINT for g in wide) and len(wide) <= 9
    assert boosting._groups([np.arange(200)] * 3, 10, 5) == [[0], [1], [2]]  # too wide to share


def test_a_task_for_each_core(spark):
    """Many small partitions are not many small tasks."""
    x, signal, w = data()
    rows = frame(spark, x, signal, w, 40).selectExpr("array(1D, 2D) AS x", "y", "w")
    blocks = boosting._binned(rows, 240, [np.array([0.5])] * 2, 0.0, 3)
    assert blocks.rows.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sum(blocks.rows.map(lambda b: len(b[1])).collect()) == 240
