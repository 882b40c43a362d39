"""Queries: the per-customer feature table and its building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.dates import tenure_days
from stayrate.functions.encoding import label_encode, one_hot
from stayrate.operators import features as fe
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import (AS_OF_SQL, COUNTRIES, TICKET_CATS, q, select_rounded,
                                     with_features)
from stayrate.sources.fixtures import AS_OF, fixture, oracle_with

FEATURE_COLUMNS = (
    ["customer_id", "signup_date", "age", "gender", "country", "plan_type", "monthly_fee",
     "tenure_days", "tenure_years", "plan_encoded", "gender_encoded"]
    + [f"country_{c}" for c in COUNTRIES]
    + ["recency_days", "frequency", "monetary", "avg_txn_amount", "max_txn_amount", "std_txn_amount",
       "refund_count", "refund_total", "payment_method_count", "total_events", "unique_event_types",
       "total_event_value", "avg_event_value", "events_per_day", "active_days", "active_days_ratio",
       "total_tickets", "avg_resolution_time", "avg_satisfaction", "min_satisfaction",
       "max_resolution_time"]
    + [f"tickets_{c}" for c in TICKET_CATS]
    + ["recent_tickets", "tenure_fee_interaction", "events_per_ticket", "satisfaction_per_ticket",
       "monetary_per_tenure", "avg_txn_per_event"])


def features_df(spark, sf, **options):
    fx = fixture(spark, sf)
    return fe.customer_features(fx.customers, fx.transactions, fx.events, fx.support_tickets,
                                as_of=AS_OF, **options)


@register("customer_features", with_features() + select_rounded(FEATURE_COLUMNS))
def q_customer_features(spark, sf):
    """Flagship: the full point-in-time feature table (assemble_features)."""
    return finish(features_df(spark, sf))


@register("rfm", oracle_with("f_transactions") + f"""
SELECT customer_id,
  CAST({AS_OF_SQL} - max(transaction_date) AS INTEGER) AS recency_days,
  count(transaction_date) AS frequency,
  {R("sum(CAST(amount AS DECIMAL(18,4)))")} AS monetary,
  {R("CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) / count(amount)")} AS avg_txn_amount,
  {R("max(amount)")} AS max_txn_amount,
  {R("stddev_samp(amount)")} AS std_txn_amount
FROM f_transactions WHERE NOT is_refund AND transaction_date <= {AS_OF_SQL}
GROUP BY customer_id""")
def q_rfm(spark, sf):
    return finish(fe.rfm(fixture(spark, sf).transactions, AS_OF))


@register("refund_stats", oracle_with("f_transactions") + f"""
SELECT customer_id, count(amount) AS refund_count,
  {R("sum(CAST(amount AS DECIMAL(18,4)))")} AS refund_total
FROM f_transactions WHERE is_refund AND transaction_date <= {AS_OF_SQL} GROUP BY customer_id""")
def q_refund_stats(spark, sf):
    return finish(fe.refund_stats(fixture(spark, sf).transactions, AS_OF))


@register("payment_diversity", oracle_with("f_transactions") + f"""
SELECT customer_id, count(DISTINCT payment_method) AS payment_method_count
FROM f_transactions WHERE transaction_date <= {AS_OF_SQL} GROUP BY customer_id""")
def q_payment_diversity(spark, sf):
    return fe.payment_diversity(fixture(spark, sf).transactions, AS_OF)


@register("event_stats", oracle_with("f_events") + f"""
SELECT customer_id, count(event_type) AS total_events,
  count(DISTINCT event_type) AS unique_event_types,
  {R("sum(event_value)")} AS total_event_value, {R("avg(event_value)")} AS avg_event_value,
  count(DISTINCT event_date) AS active_days
FROM f_events WHERE event_date <= {AS_OF_SQL} GROUP BY customer_id""")
def q_event_stats(spark, sf):
    return finish(fe.event_stats(fixture(spark, sf).events, AS_OF))


@register("active_days", with_features() + f"""
SELECT customer_id, active_days, {R("active_days_ratio")} AS active_days_ratio FROM feat""")
def q_active_days(spark, sf):
    """Distinct active days and their ratio to each customer's own tenure."""
    f = features_df(spark, sf)
    return finish(f.select("customer_id", "active_days", "active_days_ratio"))


@register("ticket_stats", oracle_with("f_tickets") + f"""
SELECT customer_id, count(ticket_id) AS total_tickets,
  {R("avg(resolution_time_hrs)")} AS avg_resolution_time,
  {R("avg(satisfaction_score)")} AS avg_satisfaction,
  min(satisfaction_score) AS min_satisfaction,
  {R("max(resolution_time_hrs)")} AS max_resolution_time,
  {", ".join(f"count(*) FILTER (WHERE ticket_category = '{c}') AS tickets_{c}" for c in TICKET_CATS)},
  count(*) FILTER (WHERE ticket_date >= {AS_OF_SQL} - 90) AS recent_tickets
FROM f_tickets WHERE ticket_date <= {AS_OF_SQL} GROUP BY customer_id""")
def q_ticket_stats(spark, sf):
    return finish(fe.ticket_stats(fixture(spark, sf).support_tickets, AS_OF))


@register("ticket_category_pivot", oracle_with("f_tickets") + f"""
SELECT customer_id,
  {", ".join(f"count(*) FILTER (WHERE ticket_category = '{c}') AS tickets_{c}" for c in TICKET_CATS)}
FROM f_tickets GROUP BY customer_id""")
def q_ticket_category_pivot(spark, sf):
    return fe.ticket_category_pivot(fixture(spark, sf).support_tickets)


@register("recent_ticket_count", oracle_with("f_tickets") + f"""
SELECT customer_id, count(ticket_id) AS recent_tickets FROM f_tickets
WHERE ticket_date >= {AS_OF_SQL} - 90 AND ticket_date <= {AS_OF_SQL} GROUP BY customer_id""")
def q_recent_ticket_count(spark, sf):
    return fe.recent_ticket_count(fixture(spark, sf).support_tickets, AS_OF)


@register("tenure", oracle_with("f_customers") + f"""
SELECT customer_id, CAST({AS_OF_SQL} - signup_date AS INTEGER) AS tenure_days,
  {R(f"CAST({AS_OF_SQL} - signup_date AS INTEGER) / 365.0")} AS tenure_years
FROM f_customers""")
def q_tenure(spark, sf):
    c = fixture(spark, sf).customers
    out = c.select("customer_id", tenure_days("signup_date", AS_OF).alias("tenure_days"))
    return finish(out.withColumn("tenure_years", F.col("tenure_days") / F.lit(365.0)))


@register("label_encode", oracle_with("f_customers") + """
SELECT customer_id, plan_type, gender,
  CAST(dense_rank() OVER (ORDER BY plan_type) - 1 AS INTEGER) AS plan_encoded,
  CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender_encoded
FROM f_customers""")
def q_label_encode(spark, sf):
    c = fixture(spark, sf).customers.select("customer_id", "plan_type", "gender")
    c = label_encode(c, "plan_type", "plan_encoded")
    return label_encode(c, "gender", "gender_encoded")


@register("one_hot_country", oracle_with("f_customers") + "SELECT customer_id, " + ", ".join(
    f"CAST(country = '{c}' AS INTEGER) AS {q('country_' + c)}" for c in COUNTRIES) + " FROM f_customers")
def q_one_hot_country(spark, sf):
    c = fixture(spark, sf).customers.select("customer_id", "country")
    return one_hot(c, "country", prefix="country").drop("country")


@register("interaction_features", with_features() + select_rounded(
    ["customer_id", "tenure_fee_interaction", "events_per_ticket", "satisfaction_per_ticket",
     "monetary_per_tenure", "avg_txn_per_event"]))
def q_interaction_features(spark, sf):
    return finish(features_df(spark, sf).select(
        "customer_id", "tenure_fee_interaction", "events_per_ticket", "satisfaction_per_ticket",
        "monetary_per_tenure", "avg_txn_per_event"))


@register("fill_numeric_nulls", with_features() + select_rounded(
    ["customer_id", "recency_days", "std_txn_amount", "total_events", "avg_satisfaction",
     "tickets_billing", "recent_tickets"]))
def q_fill_numeric_nulls(spark, sf):
    """Customers without activity: every aggregate is 0 after the left joins."""
    return finish(features_df(spark, sf).select(
        "customer_id", "recency_days", "std_txn_amount", "total_events", "avg_satisfaction",
        "tickets_billing", "recent_tickets"))


@register("clip_lower", with_features() + f"""
SELECT customer_id, {R("events_per_day")} AS events_per_day,
  {R("monetary_per_tenure")} AS monetary_per_tenure FROM feat""")
def q_clip_lower(spark, sf):
    """Per-day rates divide by ``greatest(tenure_days, 1)``."""
    return finish(features_df(spark, sf).select("customer_id", "events_per_day", "monetary_per_tenure"))


@register("drop_identity_columns", with_features() + select_rounded(
    [c for c in FEATURE_COLUMNS if c not in fe.IDENTITY_COLUMNS]))
def q_drop_identity_columns(spark, sf):
    """The 46 model inputs (with 8 countries; one per country here)."""
    return finish(fe.drop_identity_columns(features_df(spark, sf)))
