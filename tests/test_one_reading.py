"""Snapshots of many files are one batch; queries on segments make the feature table and the labels once."""

import pytest
from pyspark.sql import functions as F

from stayrate.plans import QUERIES, q_segments
from stayrate.sources import sinks
from stayrate.streaming import scoring

SMALL = "/root/testdata/sf0.001"


def test_no_snapshot_passes_through_one_task(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "coalesce", lambda *a: pytest.fail("a whole snapshot in one task"))
    got = {str(r["as_of"]): (r["customers"], r["scored"]) for r in QUERIES["stream_daily_scoring"](spark, SMALL).collect()}
    assert len(got) == 3 and all(a == b for a, b in got.values()) and got["2001-12-31"][0] == 150


def test_a_day_of_many_files_is_one_batch(spark, tmp_path):
    base = str(tmp_path)
    feats = spark.range(60).select(F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).alias("churn_30d"))
    model = scoring.fit_churn_pipeline(feats, cols=["a"], n_trees=2)[0]
    for day in ("2024-01-01", "2024-01-02"):
        snapshot = feats.drop("churn_30d").repartition(5)
        snapshot.write.parquet(f"{base}/in/as_of={day}")
        schema = snapshot.withColumn("as_of", F.lit(None).cast("date")).schema
        scoring.stream_daily(spark, model, f"{base}/in", f"{base}/out", f"{base}/progress", schema, files_per_batch=None).awaitTermination()
    assert sinks.versions(spark, f"{base}/out") == [0, 1]
    rows = scoring.read_scores(spark, f"{base}/out").groupBy("as_of").count().collect()
    assert sorted((str(r["as_of"]), r["count"]) for r in rows) == [("2024-01-01", 60), ("2024-01-02", 60)]


@pytest.mark.parametrize("query", ["segment_profiles", "segment_scatter"])
def test_features_are_made_once(spark, monkeypatch, query):
    made, plain = [], q_segments.features_df
    monkeypatch.setattr(q_segments, "_cache", {})
    monkeypatch.setattr(q_segments, "features_df", lambda *a: made.append(1) or plain(*a))
    assert QUERIES[query](spark, SMALL).count() > 0
    assert made == [1]
