"""Queries: risk lists and retention findings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stayrate.operators import eda
from stayrate.operators import risk as rk
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import with_features
from stayrate.session import checkpoint_dir, cut_lineage
from stayrate.sources.fixtures import AS_OF, BASIC_PLAN, fixture, oracle_with

A = "DATE '2001-12-31'"
LAST_ACT = f""",
la AS (SELECT customer_id, max(d) AS last_activity FROM (
         SELECT customer_id, transaction_date AS d FROM f_transactions
         UNION ALL SELECT customer_id, event_date AS d FROM f_events) WHERE d <= {A} GROUP BY customer_id)
"""


@register("risk_flags", with_features() + LAST_ACT + f""",
rf AS (SELECT f.*, CAST({A} - coalesce(la.last_activity, f.signup_date) AS INTEGER) AS days_since_activity
       FROM feat f LEFT JOIN la ON f.customer_id = la.customer_id),
rg AS (SELECT customer_id, days_since_activity,
  days_since_activity > 30 AS flag_inactive,
  active_days_ratio < 0.1 AS flag_low_engagement,
  (total_tickets > 0 AND avg_satisfaction < 3) AS flag_low_satisfaction,
  recent_tickets >= 2 AS flag_recent_tickets,
  plan_type = '{BASIC_PLAN}' AS flag_basic_plan FROM rf)
SELECT *, CAST(CAST(flag_inactive AS INTEGER) + CAST(flag_low_engagement AS INTEGER)
  + CAST(flag_low_satisfaction AS INTEGER) + CAST(flag_recent_tickets AS INTEGER)
  + CAST(flag_basic_plan AS INTEGER) AS INTEGER) AS risk_flag_count FROM rg""")
def q_risk_flags(spark, sf):
    return rk.risk_flags(features_df(spark, sf, last_activity=True), AS_OF, BASIC_PLAN)


@register("inactive_customers", oracle_with("f_customers", "f_transactions", "f_events") + LAST_ACT + f"""
SELECT c.customer_id, la.last_activity, CAST({A} - la.last_activity AS INTEGER) AS days_inactive
FROM f_customers c LEFT JOIN la ON c.customer_id = la.customer_id
WHERE la.last_activity IS NULL OR {A} - la.last_activity > 14""")
def q_inactive_customers(spark, sf):
    """No transaction or event in the last 14 days (the win-back list)."""
    fx = fixture(spark, sf)
    return rk.inactive_customers(fx.customers, fx.transactions, fx.events, AS_OF, 14)


@register("engagement_drop", oracle_with("f_events") + f"""
SELECT customer_id, count(*) FILTER (WHERE event_date >= {A} - 6) AS events_recent,
  count(*) FILTER (WHERE event_date < {A} - 6) AS events_previous
FROM f_events WHERE event_date >= {A} - 13 AND event_date <= {A} GROUP BY customer_id
HAVING count(*) FILTER (WHERE event_date < {A} - 6) > 0
   AND count(*) FILTER (WHERE event_date >= {A} - 6) < 0.5 * count(*) FILTER (WHERE event_date < {A} - 6)""")
def q_engagement_drop(spark, sf):
    """Events in the last 7 days below half of the 7 days before."""
    return rk.engagement_drop(fixture(spark, sf).events, AS_OF)


@register("outreach_list", oracle_with("f_scores") + f"""
SELECT customer_id, {R("score")} AS score FROM f_scores WHERE score > 0.6""")
def q_outreach_list(spark, sf):
    """Customers above a 60 % churn score."""
    return finish(rk.outreach_list(fixture(spark, sf).scores))


@register("weekly_high_risk_top", oracle_with("f_scores") + f"""
SELECT customer_id, {R("score")} AS score FROM f_scores ORDER BY score DESC, customer_id LIMIT 50""")
def q_weekly_high_risk_top(spark, sf):
    """The 50 highest churn scores (a top-k report)."""
    return finish(rk.high_risk_top(fixture(spark, sf).scores, 50))


@register("churn_by_tenure_band", with_features("f_churn_labels") + f"""
SELECT CASE WHEN f.tenure_days <= 90 THEN '0-90' WHEN f.tenure_days <= 180 THEN '91-180'
            WHEN f.tenure_days <= 365 THEN '181-365' ELSE '365+' END AS tenure_band,
  count(*) AS customers, {R("avg(CAST(h.churn_30d AS DOUBLE)) * 100")} AS churn_rate
FROM feat f JOIN f_churn_labels h ON f.customer_id = h.customer_id GROUP BY 1""")
def q_churn_by_tenure_band(spark, sf):
    fx = fixture(spark, sf)
    return finish(rk.churn_by_tenure_band(features_df(spark, sf), fx.churn_labels))


@register("churn_by_satisfaction_band", with_features("f_churn_labels") + f""",
sb AS (SELECT CASE WHEN f.avg_satisfaction < 3 THEN 'low' ELSE 'high' END AS satisfaction_band,
         count(*) AS customers, avg(CAST(h.churn_30d AS DOUBLE)) AS churn_rate
       FROM feat f JOIN f_churn_labels h ON f.customer_id = h.customer_id
       WHERE f.total_tickets > 0 GROUP BY 1)
SELECT satisfaction_band, customers, {R("churn_rate")} AS churn_rate,
  {R("(SELECT churn_rate FROM sb WHERE satisfaction_band = 'low') / "
     "(SELECT churn_rate FROM sb WHERE satisfaction_band = 'high')")} AS low_to_high_ratio FROM sb""")
def q_churn_by_satisfaction_band(spark, sf):
    """Churn of customers with mean satisfaction < 3 against >= 3."""
    fx = fixture(spark, sf)
    return finish(eda.churn_by_satisfaction_band(features_df(spark, sf), fx.churn_labels))


@register("value_and_churn_by_refunds", with_features("f_clv_labels", "f_churn_labels") + f"""
SELECT CASE WHEN f.refund_count = 0 THEN '0' WHEN f.refund_count = 1 THEN '1' ELSE '2+' END AS refund_band,
  count(*) AS customers, {R("avg(l.clv)")} AS mean_clv, {R("avg(CAST(h.churn_30d AS DOUBLE))")} AS churn_rate
FROM feat f JOIN f_clv_labels l ON f.customer_id = l.customer_id
JOIN f_churn_labels h ON f.customer_id = h.customer_id GROUP BY 1""")
def q_value_and_churn_by_refunds(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.value_and_churn_by_refunds(features_df(spark, sf), fx.clv_labels, fx.churn_labels))


TOP_SQL = """,
cut AS (SELECT quantile_cont(clv, 0.8) AS c FROM f_clv_labels),
hv AS (SELECT f.*, l.clv, CASE WHEN l.clv >= (SELECT c FROM cut) THEN 'top' ELSE 'rest' END AS value_group
       FROM feat f JOIN f_clv_labels l ON f.customer_id = l.customer_id)
"""


@register("high_value_profile", with_features("f_clv_labels") + TOP_SQL + f"""
SELECT value_group, count(*) AS customers, {R("avg(clv)")} AS mean_clv,
  {R("avg(tenure_days)")} AS mean_tenure_days, {R("avg(age)")} AS mean_age,
  {R("avg(active_days_ratio)")} AS mean_active_days_ratio, {R("avg(avg_satisfaction)")} AS mean_satisfaction,
  {R("avg(total_tickets)")} AS mean_tickets, {R("CAST(sum(CAST(monthly_fee AS DECIMAL(18,4))) AS DOUBLE) / count(monthly_fee)")} AS mean_fee
FROM hv GROUP BY 1""")
def q_high_value_profile(spark, sf):
    """Top clv quintile against the rest."""
    fx = fixture(spark, sf)
    return finish(rk.high_value_profile(features_df(spark, sf), fx.clv_labels))


@register("high_value_plan_share", with_features("f_clv_labels") + TOP_SQL + f"""
SELECT value_group, plan_type, count(*) AS customers,
  {R("count(*) / (SELECT count(*) FROM hv h2 WHERE h2.value_group = hv.value_group)")} AS share
FROM hv GROUP BY value_group, plan_type""")
def q_high_value_plan_share(spark, sf):
    fx = fixture(spark, sf)
    return finish(rk.high_value_plan_share(features_df(spark, sf), fx.clv_labels))


@register("daily_churn_scoring")
def q_daily_churn_scoring(spark, sf):
    """Fit the churn pipeline on the stratified training part, save it and
    load it back, score every customer's features as of the prediction date
    and write the scores partitioned by date; returns the scores read back
    from that partition."""
    from stayrate.operators import prep
    from stayrate.streaming.scoring import fit_churn_pipeline, save_pipeline, score_daily
    fx = fixture(spark, sf)
    feats = cut_lineage(features_df(spark, sf))  # the split, the fit and the scoring read them
    labelled = prep.stratified_split(eda.attach_labels(feats, fx.churn_labels), "churn_30d", 0.2, 42)
    train = cut_lineage(labelled.where(F.col("split") == "train").drop("split"))
    model, _ = fit_churn_pipeline(train)
    base = f"{checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    model = save_pipeline(model, f"{base}/model")
    return finish(score_daily(spark, model, feats, AS_OF, f"{base}/scores"))


DAYS = ["2001-10-31", "2001-11-30", "2001-12-31"]


@register("stream_daily_scoring", oracle_with("f_customers") + f"""
SELECT d.as_of, count(*) AS customers, count(*) AS scored
FROM (VALUES {", ".join(f"(DATE '{d}')" for d in DAYS)}) AS d(as_of) JOIN f_customers c ON c.signup_date <= d.as_of GROUP BY 1""")
def q_stream_daily_scoring(spark, sf):
    """Feature snapshots of three days scored as a stream, a committed batch each; customers and valid scores per day."""
    from stayrate.operators import features as fe
    from stayrate.operators.store import rename
    from stayrate.streaming.scoring import fit_churn_pipeline, read_scores, stream_daily
    fx = fixture(spark, sf)
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    for day in DAYS:
        known = fx.customers.where(F.col("signup_date") <= F.lit(day).cast("date"))
        fe.customer_features(known, fx.transactions, fx.events, fx.support_tickets, as_of=day).write.parquet(f"{base}/made/as_of={day}")
    last = spark.read.parquet(f"{base}/made/as_of={DAYS[-1]}")
    schema = last.withColumn("as_of", F.lit(None).cast("date")).schema
    model, _ = fit_churn_pipeline(cut_lineage(eda.attach_labels(last, fx.churn_labels)), n_trees=10)
    for day in DAYS:  # a day's files, however many, arrive by one rename and are one batch
        rename(spark, f"{base}/made/as_of={day}", f"{base}/snapshots/as_of={day}")
        stream_daily(spark, model, f"{base}/snapshots", f"{base}/scores", f"{base}/progress", schema, files_per_batch=None).awaitTermination()
    ok = F.col("churn_probability").between(0, 1)
    return read_scores(spark, f"{base}/scores").groupBy("as_of").agg(F.count(F.lit(1)).alias("customers"), F.count_if(ok).alias("scored"))
