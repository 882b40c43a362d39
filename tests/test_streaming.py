"""Daily scoring as a stream: killed between days, restarted, nothing lost or twice."""

import pytest
from pyspark.sql import functions as F

from stayrate.sources import sinks
from stayrate.streaming import scoring

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


@pytest.fixture(scope="module")
def model(spark):
    feats = spark.range(80).select(F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"),
                                   (F.col("id") % 2).alias("churn_30d"))
    return scoring.fit_churn_pipeline(feats, cols=["a"], n_trees=2)[0]


def snapshots(spark, base, days=DAYS):
    for k, day in enumerate(days):
        (spark.range(10 + k).select(F.col("id").alias("customer_id"), (F.col("id") % 7).cast("double").alias("a"), F.lit(day).cast("date").alias("as_of"))
         .coalesce(1).write.mode("append").parquet(f"{base}/in"))
    return spark.read.parquet(f"{base}/in").schema


def run(spark, model, base, schema, on_batch=None):
    q = scoring.stream_daily(spark, model, f"{base}/in", f"{base}/out", f"{base}/progress", schema, on_batch=on_batch)
    q.awaitTermination()


def per_day(spark, base):
    return {str(r["as_of"]): r["count"] for r in scoring.read_scores(spark, f"{base}/out").groupBy("as_of").count().collect()}


@pytest.mark.parametrize("when", ["before", "after"])
def test_killed_between_days_resumes(spark, model, tmp_path, monkeypatch, when):
    base = str(tmp_path)
    schema = snapshots(spark, base)
    plain = sinks.commit_as

    def dies(batch):
        if batch == 1:
            raise RuntimeError("killed after the commit")

    if when == "before":  # rows of the second day are written, not committed
        monkeypatch.setattr(sinks, "commit_as", lambda s, p, f, n: plain(s, p, f, n) if n != 1 else 1 / 0)
    with pytest.raises(Exception):
        run(spark, model, base, schema, dies if when == "after" else None)
    assert sinks.versions(spark, f"{base}/out") == ([0] if when == "before" else [0, 1])
    assert len(per_day(spark, base)) == (1 if when == "before" else 2)
    monkeypatch.undo()
    run(spark, model, base, schema)
    assert per_day(spark, base) == {d: 10 + k for k, d in enumerate(DAYS)}
    assert sinks.versions(spark, f"{base}/out") == [0, 1, 2]
    # a run without new files changes nothing; a new day is one more batch
    run(spark, model, base, schema)
    snapshots(spark, base, ["2024-01-04"])
    run(spark, model, base, schema)
    got = per_day(spark, base)
    assert got["2024-01-04"] == 10 and sum(got.values()) == 43
    bad = scoring.read_scores(spark, f"{base}/out").where("churn_probability < 0 OR churn_probability > 1 OR churn_probability IS NULL")
    assert bad.isEmpty()


def test_no_scores_yet(spark, tmp_path):
    assert scoring.read_scores(spark, str(tmp_path / "none")).count() == 0
