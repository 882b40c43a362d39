"""The exact neighbour join and SMOTE against brute force."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.operators import knn, prep


def brute(rows, k):
    out = {}
    for key, v in rows:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), other) for other, w in rows if other != key)
        out[key] = [(i + 1, other, pytest.approx(x, rel=1e-12, abs=1e-12)) for i, (x, other) in enumerate(d[:k])]
    return out


def joined(spark, rows, k, parts=4):
    df = spark.createDataFrame([(a, [float(x) for x in v]) for a, v in rows], "key string, v array<double>").repartition(parts)
    near, compared = knn.knn_join(df, k)
    out = collections.defaultdict(list)
    for r in near.orderBy("key", "rank").collect():
        out[r["key"]].append((r["rank"], r["neighbour"], r["distance"]))
    return dict(out), compared


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(0, 8, (12, 5))
    rows = [(f"k{n:04}", v) for n, v in enumerate(centre[rng.integers(0, 12, 900)] + rng.normal(0, 1, (900, 5)))]
    rows += [(f"t{n}", np.round(v)) for n, v in enumerate(rng.normal(0, 1, (120, 5)))]  # ties and equal vectors
    got, compared = joined(spark, rows, 5)
    assert got == brute(rows, 5)
    assert compared < 0.6 * len(rows)


def test_comparisons_fall_behind_the_rows(spark):
    """Clustered rows: four times the rows cost far less than four times the comparisons a row."""
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 30, (300, 6))
    cost = []
    for n in (2_000, 8_000):
        x = centre[rng.integers(0, 300, n)] + rng.normal(0, 1, (n, 6))
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "key long, v array<double>")
        near, compared = knn.knn_join(df, 3)
        assert near.count() == 3 * n
        cost.append(compared)
    assert cost[1] < 3 * cost[0] and cost[1] < 0.1 * 8_000


def test_hot_copies_meet_as_one(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 16)  # cells of several blocks
    rng = np.random.default_rng(3)
    rows = [(f"a{n:03}", [1.0, 2.0]) for n in range(300)] + [(f"b{n:03}", v) for n, v in enumerate(rng.normal(0, 2, (200, 2)))]
    got, compared = joined(spark, rows, 4, 7)
    assert got == brute(rows, 4)
    assert compared < 260


def test_few_rows(spark):
    assert joined(spark, [("a", [1.0])], 5)[0] == {}
    assert joined(spark, [("a", [1.0]), ("b", [3.0])], 5)[0] == {"a": [(1, "b", 2.0)], "b": [(1, "a", 2.0)]}
    assert joined(spark, [("a", [1.0]), ("b", [1.0])], 1)[0] == {"a": [(1, "b", 0.0)], "b": [(1, "a", 0.0)]}
    empty = spark.createDataFrame([], "key string, v array<double>")
    assert knn.knn_join(empty, 3)[0].count() == 0


def test_smote_balances_between_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(n, 0 if n % 5 else 1, *map(float, rng.normal(n % 5, 1, 2))) for n in range(403)] + [(900, None, 0.0, 0.0), (901, 2, 5.0, None)]
    df = spark.createDataFrame(rows, "customer_id long, y int, a double, b double")
    made = prep.smote(df, "y", ["a", "b"], k=5).collect()
    counts = collections.Counter(r[1] for r in rows if r[1] is not None)
    for r in made:
        counts[r["y"]] += 1
    assert set(counts.values()) == {counts[0]} and set(counts) == {0, 1, 2}
    at = {r[0]: np.array([r[2], r[3] or 0.0]) for r in rows}
    near = brute([(n, at[n]) for n, y, *_ in rows if y == 1], 5)
    used = collections.Counter()
    for r in made:
        if r["y"] == 2:  # a class of one row repeats it
            assert (r["base"], r["neighbour"], r["a"], r["b"]) == (901, 901, 5.0, 0.0)
            continue
        assert r["neighbour"] in [other for _, other, _ in near[r["base"]]] and 0 <= r["u"] < 1
        assert np.allclose([r["a"], r["b"]], at[r["base"]] + r["u"] * (at[r["neighbour"]] - at[r["base"]]), atol=1e-12)
        used[r["base"]] += 1
    assert max(used.values()) - min(used.values()) <= 1 and len(used) == 81
    again = prep.smote(df.repartition(9), "y", ["a", "b"], k=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, made))
    both = prep.balanced(df, "y", ["a", "b"]).groupBy("y").count().where("y IS NOT NULL").collect()
    assert {r["count"] for r in both} == {counts[0]}
    assert prep.smote(df.where("y = 0"), "y", ["a", "b"]).count() == 0
    assert prep.smote(df.limit(0), "y", ["a", "b"]).count() == 0


def test_oversampled_training_part(spark):
    from conftest import SMALL
    from stayrate.operators import models as mo
    from stayrate.plans import QUERIES, q_models
    mf = q_models.churn_frame(spark, SMALL)
    more = mo.oversampled(mf)
    counts = {r["target"]: r["count"] for r in more.train.groupBy("target").count().collect()}
    plain = {r["target"]: r["count"] for r in mf.train.groupBy("target").count().collect()}
    assert counts[0.0] == counts[1.0] == plain[0.0] > plain[1.0] and more.n_train == 2 * plain[0.0]
    rows = {r["training"]: r for r in QUERIES["compare_resampling"](spark, SMALL).collect()}
    assert set(rows) == {"plain", "class weights", "smote"} and all(0 <= r["auc"] <= 1 for r in rows.values())
    assert rows["smote"]["n_train"] == more.n_train > rows["plain"]["n_train"]


def test_split_plans_no_product_even_without_broadcasts(spark, monkeypatch):
    """The eager jobs of the split too: every plan that runs is looked at."""
    seen = []
    plain = type(spark.range(1)).first
    monkeypatch.setattr(type(spark.range(1)), "first", lambda self: (seen.append(self._jdf.queryExecution().executedPlan().toString()), plain(self))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = prep.train_test_split(spark.range(1000).withColumnRenamed("id", "customer_id"), 0.2)
        seen.append(out._jdf.queryExecution().executedPlan().toString())
        assert out.where("split = 'test'").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(seen) > 1 and not any("CartesianProduct" in p or "NestedLoop" in p or "Join" in p for p in seen)
    assert {r["split"] for r in prep.train_test_split(spark.range(3).withColumnRenamed("id", "customer_id"), 0.0).collect()} == {"train"}
    assert {r["split"] for r in prep.train_test_split(spark.range(3).withColumnRenamed("id", "customer_id"), 1.0).collect()} == {"test"}
    assert prep.train_test_split(spark.range(0).withColumnRenamed("id", "customer_id"), 0.5).count() == 0
