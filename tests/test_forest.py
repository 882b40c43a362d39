"""Random forests: the same trees however large nodes are split; splits and leaves against brute force."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from stayrate.operators import forest
from stayrate.session import cut_lineage


def frame(spark, x, y, w, parts=3):
    rows = [(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x.tolist(), y, w)]
    return cut_lineage(spark.createDataFrame(rows, ["features", "y", "w"]).repartition(parts))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 5))
    x[:, 3] = rng.integers(0, 2, 900)
    x[rng.random(900) < 0.1, 1] = np.nan
    y = 3 * x[:, 0] + np.where(np.isnan(x[:, 1]), 2.0, x[:, 1] > 0) + rng.normal(scale=0.2, size=900)
    w = rng.choice([0.5, 2.0], 900)
    return x, y, w, frame(spark, x, y, w), frame(spark, x, y > 1, w)


@pytest.mark.parametrize("classes,per_split", [(False, None), (True, 2)])
def test_handing_over_does_not_change_the_trees(data, monkeypatch, classes, per_split):
    df = data[4 if classes else 3]
    args = dict(weight="w", classes=classes, n_trees=6, depth=7, per_split=per_split, bins=16)
    whole = forest.fit_forest(df, "y", **args)
    monkeypatch.setattr(forest, "quantile_cuts", lambda *a: whole.cuts)
    for hand_over in (200, 30):
        parts = forest.fit_forest(df, "y", hand_over=hand_over, **args)
        for a, b in zip(whole.trees, parts.trees):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.missing_left == b.missing_left).all()
            assert a.weight == pytest.approx(b.weight) and a.gain == pytest.approx(b.gain)


def test_splits_are_those_of_least_variance(data):
    """The root of every tree against all cuts of its drawn rows; leaves are means."""
    df = data[3]
    model = forest.fit_forest(df, "y", weight="w", n_trees=3, depth=3, bins=16)
    rows = forest._blocks(df.select(forest.vector_to_array("features").alias("x"), "y", "w"), model.cuts, 5).collect()
    times, *_ = forest._growing()
    for t, tree in enumerate(model.trees):
        b = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, 5) for r in rows])
        y = np.concatenate([np.frombuffer(r["y"]) for r in rows])
        w = np.concatenate([np.frombuffer(r["w"]) * times(42, r["part"], r["block"], t, r["m"]) for r in rows])

        def spread(at):
            return (w[at] * (y[at] - np.average(y[at], weights=w[at])) ** 2).sum() if w[at].sum() else 0.0

        every, best = np.ones(len(y), bool), 0.0
        for f in range(5):
            for cut in range(16):
                for miss in (False, True):
                    left = np.where(b[:, f] == forest.MISSING, miss, b[:, f] <= cut)
                    if w[left].sum() and w[~left].sum():
                        best = max(best, spread(every) - spread(left) - spread(~left))
        assert tree.gain[0] == pytest.approx(best / 2)  # half the fall of the squares
        assert tree.weight[0] == pytest.approx(np.average(y, weights=w))


def test_scores_and_the_store_form(spark, data):
    x, y, w, df, classes = data
    model = forest.fit_forest(df, "y", weight="w", n_trees=30, depth=8)
    got = model.transform(df).select("y", "prediction").collect()
    assert 1 - np.var([r.y - r.prediction for r in got]) / np.var(y) > 0.9
    again = forest.ForestModel.from_json(model.to_json())
    assert [r.prediction for r in again.transform(df).collect()] == [r.prediction for r in model.transform(df).collect()]
    assert model.featureImportances.toArray().sum() == pytest.approx(1.0) and model.featureImportances.toArray().argmax() == 0
    two = forest.fit_forest(classes, "y", weight="w", classes=True, n_trees=30, depth=8, per_split=3)
    scored = two.transform(classes).collect()
    assert all(0 <= r.probability <= 1 and r.prediction == (r.probability > 0.5) for r in scored)
    assert np.mean([r.prediction == r.y for r in scored]) > 0.9
    assert forest.fit_forest(df.limit(0), "y").trees == []


def test_a_tree_ships_its_rows_once(spark, data):
    """No histogram per deep node leaves a task: what the last step shuffles are rows, each drawn one once a tree."""
    df = data[3]
    model = forest.fit_forest(df, "y", n_trees=4, depth=9)
    assert all((t.feature >= 0).sum() > 100 for t in model.trees)
    same = forest.fit_forest(df, "y", n_trees=4, depth=9)
    for a, b in zip(model.trees, same.trees):
        assert (a.feature == b.feature).all() and (a.weight == b.weight).all()


def test_splits_say_how_many_rows_the_children_have(data):
    """So no pass over all rows counts them."""
    df = data[3]
    cuts = forest.fit_forest(df, "y", n_trees=1, depth=1, bins=16).cuts
    model = forest.ForestModel(False, cuts, [forest._blank(15) for _ in range(3)])
    blocks = forest._blocks(df.select(forest.vector_to_array("features").alias("x"), "y", "w"), cuts, 5)
    rows, (times, *_) = blocks.collect(), forest._growing()
    job, (walk, *_) = (42, 3, 5, max(len(c) for c in cuts) + 2), forest._kernels()
    sizes = forest._split_large(blocks, model, [(t, 0) for t in range(3)], 5, job)
    sizes |= forest._split_large(blocks, model, list(sizes), 5, job)
    assert len(sizes) == 18
    for t, tree in enumerate(model.trees):
        b = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(-1, 5) for r in rows])
        drawn = np.concatenate([times(42, r["part"], r["block"], t, r["m"]) for r in rows]) > 0
        leaves = walk(b[drawn], tree.arrays())
        assert [sizes[t, k] for k in range(3, 7)] == [(leaves == k).sum() for k in range(3, 7)]
        assert sizes[t, 1] == np.isin(leaves, [3, 4]).sum() and sizes[t, 2] == np.isin(leaves, [5, 6]).sum()
