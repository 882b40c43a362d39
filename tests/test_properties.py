"""Property checks for the distributed algorithms against brute force."""

import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.operators import metrics as me
from stayrate.operators import quantiles as qu

from conftest import SMALL


def _skewed(seed, n=3000):
    rng = np.random.default_rng(seed)
    vals = rng.normal(100, 30, n).round(2)
    vals[: n // 3] = 42.0                       # one value holds a third of the rows
    groups = np.where(rng.random(n) < 0.5, "a", "b")
    groups[: n // 3] = "a"                      # and one group most of the rows
    return list(zip(groups.tolist(), vals.tolist()))


@pytest.mark.parametrize("seed,rank_rows", [(1, 3), (2, 40), (3, qu.RANK_ROWS)])
def test_exact_quantiles_match_numpy(spark, seed, rank_rows):
    """direct_rows=0 forces the sketch-bracket path (small accuracy, so
    brackets are narrow and get verified / widened)."""
    rows = _skewed(seed)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r.g, r.p): r.quantile for r in qu.exact_quantiles(df, "v", probs, ["g"], rank_rows=rank_rows).collect()}
    for g in ("a", "b"):
        arr = np.array([v for gg, v in rows if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.percentile(arr, p * 100)), abs=1e-9), (g, p)
    whole = qu.quantile_row(df, "v", [0.5], ["med"], rank_rows=rank_rows).first()["med"]
    assert whole == pytest.approx(float(np.median([v for _, v in rows])))


def _brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(pairs):
    thr = sorted({s for _, s in pairs}, reverse=True)
    P = sum(y for y, _ in pairs)
    ap, prev_r = 0.0, 0.0
    for t in thr:
        tp = sum(1 for y, s in pairs if s >= t and y == 1)
        fp = sum(1 for y, s in pairs if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_auc_and_ap_match_brute_force(spark):
    rng = np.random.default_rng(7)
    y = (rng.random(400) < 0.3).astype(int)
    s = np.round(rng.random(400) * 0.5 + y * 0.3, 2)          # many ties
    pairs = list(zip(y.tolist(), s.tolist()))
    df = spark.createDataFrame(pairs, "label int, score double").repartition(4)
    assert me.roc_auc(df).first()["auc"] == pytest.approx(_brute_auc(pairs))
    assert me.average_precision(df).first()["average_precision"] == pytest.approx(_brute_ap(pairs))
    # running totals across many small buckets equal a plain cumulative sum
    old = me.ROWS_PER_BUCKET
    me.ROWS_PER_BUCKET = 10                          # force several equal-count buckets
    try:
        rt = me.running_totals(me.score_counts(df), "score", ["pos"], descending=True, buckets=7)
        got = {r.score: r.cum_pos for r in rt.collect()}
    finally:
        me.ROWS_PER_BUCKET = old
    for t in set(s.tolist()):
        assert got[t] == sum(1 for yy, ss in pairs if ss >= t and yy == 1)


def test_models_and_importances(spark):
    from stayrate.plans import QUERIES
    table = QUERIES["compare_models_regression"](spark, SMALL).collect()
    assert len(table) == 5 and all(r.rmse >= 0 for r in table)
    imp = QUERIES["feature_importance_classification"](spark, SMALL).collect()
    assert 0 < len(imp) <= 15
    scored = QUERIES["score_classification"](spark, SMALL).collect()
    assert all(0.0 <= r.score <= 1.0 for r in scored)
    assert sum(r.is_best for r in table) == 1 and max(table, key=lambda r: r.r2).is_best
    classes = QUERIES["compare_models_classification"](spark, SMALL).collect()
    assert sum(r.is_best for r in classes) == 1 and max(classes, key=lambda r: r.auc).is_best
    auc = {r.model: r.auc for r in classes}
    roc = QUERIES["model_roc_curves"](spark, SMALL).toPandas()
    for name, c in roc.groupby("model"):
        c = c.sort_values(["fpr", "tpr"])
        area = float(np.trapezoid([0.0, *c.tpr], [0.0, *c.fpr]))
        assert area == pytest.approx(auc[name], abs=1e-4)
    cells = QUERIES["best_model_confusion_matrix"](spark, SMALL).collect()
    assert cells
    assert {r.model for r in QUERIES["model_average_precision"](spark, SMALL).collect()} == set(auc)
    from stayrate.plans.q_models import _classification
    bundle = _classification(spark, SMALL).bundle
    assert len(bundle.models) == 4
    trees = [m for m in map(bundle.model, bundle.models) if hasattr(m, "featureImportances")]
    assert len(trees) == 3 and all(f.featureImportances.toArray().sum() == pytest.approx(1.0) for f in trees)
    assert all(getattr(f, "getNumTrees", 200) == 200 for f in trees)
    for name in ("fit_boosted_regressor", "fit_boosted_classifier", "fit_ridge"):
        assert QUERIES[name](spark, SMALL).count() > 0


def test_a_second_session_scores_without_fitting(spark, monkeypatch):
    """The models of a bake-off come from the store; changed input has another key."""
    from stayrate.operators import models as mo
    from stayrate.plans import q_models
    first = q_models._classification(spark, SMALL)
    monkeypatch.setattr(mo, "build_model_frame", lambda *a, **k: pytest.fail("fitted again"))
    other = spark.newSession()
    again = q_models._classification(other, SMALL)
    assert again.bundle.path == first.bundle.path
    a = {r.customer_id: r.score for r in mo.score_classification(first.model(), first.test).collect()}
    b = {r.customer_id: r.score for r in mo.score_classification(again.model(), again.test).collect()}
    assert a == b
    from stayrate.operators.store import fingerprint
    one, two = spark.range(5), spark.range(6)
    assert fingerprint(one) == fingerprint(spark.range(5).repartition(3)) != fingerprint(two)


def test_the_store_keeps_whole_bundles_only(spark, tmp_path):
    from stayrate.operators.store import ModelStore
    from stayrate.operators.models import LinearModel
    from pyspark.ml.linalg import DenseVector
    store = ModelStore(spark, str(tmp_path))
    key = store.key("m", [spark.range(3)], {"a": 1})
    assert key != store.key("m", [spark.range(3)], {"a": 2}) and store.get(key) is None

    def broken():
        return {"lin": LinearModel(DenseVector([1.0, 2.0]), 3.0), "bad": object()}, {}, {}

    with pytest.raises(AttributeError):
        store.get_or_fit(key, broken)
    assert store.get(key) is None
    fits = []

    def whole():
        fits.append(1)
        return {"lin": LinearModel(DenseVector([1.0, 2.0]), 3.0)}, {"rows": spark.range(4)}, {"best": "lin"}

    for _ in range(2):
        b = store.get_or_fit(key, whole)
        assert b.model("lin").coefficients.toArray().tolist() == [1.0, 2.0] and b.frame("rows").count() == 4
    assert fits == [1] and b.facts == {"best": "lin"}


@pytest.mark.parametrize("alpha", [1.0, 25.0])
def test_ridge_and_linear_equal_the_closed_form(spark, alpha):
    from pyspark.ml.linalg import Vectors
    from stayrate.operators import models as mo
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    x[:, 2] = 0.9 * x[:, 0] + 0.1 * x[:, 2]
    y = 7.0 * x[:, 0] + 14.0 * x[:, 1] - 3.0 * x[:, 2] + rng.normal(scale=4.0, size=400)
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y)], ["features", "target"])
    ests = mo.regression_estimators(400, float(np.std(y, ddof=1)), alpha=alpha)
    xc, yc = x - x.mean(0), y - y.mean()
    for name, a in (("Ridge Regression", alpha), ("Linear Regression", 0.0)):
        want = np.linalg.solve(xc.T @ xc + a * np.eye(3), xc.T @ yc)
        assert ests[name].fit(df).coefficients.toArray() == pytest.approx(want, abs=1e-2)


def test_stratified_split_with_null_and_many_labels(spark):
    from stayrate.operators import prep
    rows = [(k, None if k % 5 == 0 else k % 3) for k in range(500)]
    df = spark.createDataFrame(rows, "customer_id int, y int")
    got = prep.stratified_split(df, "y", 0.2)
    n = {(r.y, r.split): r["count"] for r in got.groupBy("y", "split").count().collect()}
    counts = {}
    for _, y in rows:
        counts[y] = counts.get(y, 0) + 1
    assert sum(v for (_, s), v in n.items() if s == "test") == 100
    assert all(abs(n[(y, "test")] - 0.2 * c) < 1 for y, c in counts.items())
    many = spark.range(5000).select(F.col("id").alias("customer_id"), (F.col("id") % 1000).alias("y"))
    got = prep.stratified_split(many, "y", 0.2).where("split = 'test'")
    assert got.count() == 1000 and got.groupBy("y").count().where("count <> 1").isEmpty()


def test_small_group_beside_a_large_one(spark):
    from stayrate.operators import quantiles as q
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.sqrt(F.col("id").cast("double")).alias("v")).union(
        spark.createDataFrame([("b", 1.0), ("b", 5.0), ("b", 2.0), (None, 3.0), ("c", None)], "g string, v double"))
    got = {(r.g, r.p): r.quantile for r in q.exact_quantiles(df, "v", [0.25, 0.5], ["g"], rank_rows=500).collect()}
    a = np.sqrt(np.arange(200_000.0))
    assert got[("a", 0.5)] == pytest.approx(np.quantile(a, 0.5)) and got[("a", 0.25)] == pytest.approx(np.quantile(a, 0.25))
    assert (got[("b", 0.5)], got[("b", 0.25)], got[(None, 0.5)]) == (2.0, 1.5, 3.0) and ("c", 0.5) not in got


def test_ordered_results(spark):
    from stayrate.plans import QUERIES
    for name, key in (("clv_by_plan", lambda r: (r.mean_clv, r.plan_type)),
                      ("churn_rate_by_country", lambda r: (-r.churn_rate, r.country)),
                      ("value_counts_payment_method", lambda r: (-r["count"], r["value"])),
                      ("satisfaction_counts", lambda r: r.satisfaction_score),
                      ("satisfaction_by_category", lambda r: (r.avg_satisfaction, r.ticket_category)),
                      ("outreach_list", lambda r: (-r.score, r.customer_id)),
                      ("sort_by_customer_date", lambda r: (r.customer_id, r.transaction_date))):
        rows = QUERIES[name](spark, SMALL).collect()
        assert len(rows) > 1 and rows == sorted(rows, key=key), name


def test_daily_scores_of_two_folders_do_not_meet(spark, tmp_path):
    from stayrate.streaming import scoring
    feats = spark.range(60).select(F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"),
                                   (F.col("id") % 2).alias("churn_30d"))
    model, _ = scoring.fit_churn_pipeline(feats, cols=["a"], n_trees=2)
    model = scoring.save_pipeline(model, f"{tmp_path}/model")
    one = scoring.score_daily(spark, model, feats, "2024-01-01", f"{tmp_path}/one")
    two = scoring.score_daily(spark, model, feats.limit(10), "2024-01-01", f"{tmp_path}/two")
    assert (one.count(), two.count()) == (60, 10)


def test_library_needs_a_shared_folder():
    from unittest.mock import MagicMock
    from stayrate.session import checkpoint_dir
    session = MagicMock()
    session.sparkContext.getCheckpointDir.return_value = None
    session.conf.get.return_value = None
    with pytest.raises(RuntimeError):
        checkpoint_dir(session)


def test_linear_fit_residuals_orthogonal(spark):
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 2))
    yv = 1.5 * x[:, 0] - 2.0 * x[:, 1] + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, yv)], "a double, b double, y double")
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    m = LinearRegression(labelCol="y", regParam=0.0, standardization=False).fit(v)
    res = m.transform(v).select((F.col("y") - F.col("prediction")).alias("r"), "a", "b")
    dots = res.agg(F.sum(F.col("r") * F.col("a")), F.sum(F.col("r") * F.col("b")), F.sum("r")).first()
    assert all(abs(d) < 1e-6 for d in dots)


def test_segments_relabelled_and_pca(spark):
    from stayrate.plans import QUERIES
    summ = {r.segment: r.mean_clv for r in QUERIES["kmeans_segment_summary"](spark, SMALL).collect()}
    order = [summ[k] for k in sorted(summ)]
    assert order == sorted(order, reverse=True)
    ev = [r.explained_variance_ratio for r in QUERIES["pca_explained_variance"](spark, SMALL).collect()]
    assert len(ev) == 2 and ev[0] >= ev[1] and sum(ev) <= 1.0 + 1e-9


def test_streaming_daily_scoring(spark):
    from stayrate.operators import eda
    from stayrate.plans.q_features import features_df
    from stayrate.sources.fixtures import fixture
    from stayrate.streaming.scoring import fit_churn_pipeline, stream_scores
    fx = fixture(spark, SMALL)
    feats = features_df(spark, SMALL)
    model, _ = fit_churn_pipeline(eda.attach_labels(feats, fx.churn_labels), n_trees=3)
    base = tempfile.mkdtemp(prefix="stayrate-stream-")
    snap = feats.withColumn("as_of", F.lit("2001-12-31").cast("date"))
    snap.write.parquet(f"{base}/snapshots/day=1")
    q = stream_scores(spark, model, f"{base}/snapshots/day=1", f"{base}/scores", f"{base}/ckpt", snap.schema)
    q.awaitTermination(300)
    out = spark.read.parquet(f"{base}/scores")
    assert out.count() == feats.count()
    assert out.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0
