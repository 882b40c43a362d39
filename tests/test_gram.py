"""The shared Gram aggregate: correlations, regressions and components against numpy."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayrate.operators import gram as gm
from stayrate.operators import profile


def frame(spark, x, names, parts=5):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], names).repartition(parts)


@pytest.mark.parametrize("block", [128, 3])
def test_equals_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(gm, "BLOCK", block)
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, (700, 7)) @ rng.normal(0, 1, (7, 7))  # far from zero: products must be centred
    names = [f"c{k}" for k in range(7)]
    g = gm.gram(frame(spark, x, names), names)
    assert g.n == 700 and np.allclose(g.mean, x.mean(0))
    assert np.allclose(g.products / 699, np.cov(x.T), rtol=1e-7)
    assert np.allclose(g.correlation(), np.corrcoef(x.T), atol=1e-8)
    v = spark.createDataFrame([(Vectors.dense(r), float(r[0])) for r in x], ["v", "y"])
    both = gm.gram(v, [("t", F.col("y") * 2)], "v", names)
    assert both.names == ["t", *names] and np.allclose(both.of(names).products, g.products)
    assert both.correlation()[0, 1] == pytest.approx(1)


def test_forty_six_columns_are_one_aggregate_of_one_vector(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, 46))
    names = [f"c{k}" for k in range(46)]
    df = frame(spark, x, names)
    rows = profile.correlation_matrix(df, names).collect()
    want = np.corrcoef(x.T)
    assert len(rows) == 46 * 47 // 2
    assert all(r["corr"] == pytest.approx(want[int(r["var1"][1:]), int(r["var2"][1:])]) for r in rows)


def test_all_ridge_penalties_from_one_pass(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 2, (200, 4))
    x[:, 3] = x[:, 0] + x[:, 1]  # made up of others
    y = x @ [1.0, -2.0, 0.5, 0.0] + 3 + rng.normal(0, 0.1, 200)
    g = gm.gram(frame(spark, np.column_stack([x, y]), ["a", "b", "c", "d", "y"]), ["a", "b", "c", "d", "y"])
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.0, 0.5, 10.0, 1000.0):
        coef, intercept = g.solve("y", alpha)
        if alpha:
            assert np.allclose(coef, np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc))
        assert intercept == pytest.approx(y.mean() - x.mean(0) @ coef)
        # normal equations
        assert np.allclose(xc.T @ (yc - xc @ coef), alpha * coef, atol=1e-7)


def test_components_equal_spark_ml(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (300, 5)) @ rng.normal(0, 1, (5, 5))
    names = list("abcde")
    df = frame(spark, x, names)
    load, share = gm.gram(df, names).components(2)
    model = PCA(k=2, inputCol="v", outputCol="p").fit(VectorAssembler(inputCols=names, outputCol="v").transform(df))
    want = model.pc.toArray()
    assert np.allclose(np.abs(load.T @ want), np.eye(2), atol=1e-8)
    assert np.allclose(share, model.explainedVariance.toArray())
    assert all(load[np.abs(load[:, k]).argmax(), k] > 0 for k in range(2))


def test_awkward_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 1.0), (3.0, 2.0)], "a double, b double")
    g = gm.gram(df, ["a", "b"])
    assert g.n == 2 and g.mean.tolist() == [2.0, 2.0] and np.isnan(g.correlation()[1, 1]) and g.correlation()[0, 0] == 1
    none = gm.gram(df.limit(0), ["a", "b"])
    assert none.n == 0 and none.solve("b")[0].tolist() == [0.0]
    assert {r["corr"] for r in profile.correlation_matrix(df.limit(0), ["a", "b"]).collect()} == {None}
