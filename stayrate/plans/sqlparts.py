"""Reusable SQL text for the DuckDB oracles (independent of the Spark code)."""

from __future__ import annotations

from stayrate.plans.registry import R
from stayrate.sources.fixtures import oracle_with

AS_OF_SQL = "DATE '2001-12-31'"
TICKET_CATS = ["account", "billing", "cancellation", "feature_request", "technical"]
# Expected country levels of the driver's nation table (names NATION_0 .. NATION_24).
COUNTRIES = sorted(f"NATION_{i}" for i in range(25))


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def feature_ctes() -> str:
    """CTEs ``o_txn``, ``o_ev``, ``o_tk``, ``o_base`` and ``feat`` (the 51+ columns)."""
    cats = ",\n".join(
        f"    count(*) FILTER (WHERE ticket_category = '{c}') AS tickets_{c}" for c in TICKET_CATS)
    dummies = ",\n".join(
        f"    CAST(country = '{c}' AS INTEGER) AS {q('country_' + c)}" for c in COUNTRIES)
    return f""",
o_txn AS (
  SELECT customer_id,
    CAST({AS_OF_SQL} - max(transaction_date) FILTER (WHERE NOT is_refund) AS INTEGER) AS recency_days,
    count(*) FILTER (WHERE NOT is_refund) AS frequency,
    CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (WHERE NOT is_refund) AS DOUBLE) AS monetary,
    CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (WHERE NOT is_refund) AS DOUBLE)
      / NULLIF(count(*) FILTER (WHERE NOT is_refund), 0) AS avg_txn_amount,
    max(amount) FILTER (WHERE NOT is_refund) AS max_txn_amount,
    stddev_samp(amount) FILTER (WHERE NOT is_refund) AS std_txn_amount,
    count(*) FILTER (WHERE is_refund) AS refund_count,
    CAST(sum(CAST(amount AS DECIMAL(18,4))) FILTER (WHERE is_refund) AS DOUBLE) AS refund_total,
    count(DISTINCT payment_method) AS payment_method_count
  FROM f_transactions WHERE transaction_date <= {AS_OF_SQL} GROUP BY customer_id),
o_ev AS (
  SELECT customer_id, count(event_type) AS total_events,
    count(DISTINCT event_type) AS unique_event_types,
    sum(event_value) AS total_event_value, avg(event_value) AS avg_event_value,
    count(DISTINCT event_date) AS active_days
  FROM f_events WHERE event_date <= {AS_OF_SQL} GROUP BY customer_id),
o_tk AS (
  SELECT customer_id, count(ticket_id) AS total_tickets,
    avg(resolution_time_hrs) AS avg_resolution_time,
    avg(satisfaction_score) AS avg_satisfaction,
    min(satisfaction_score) AS min_satisfaction,
    max(resolution_time_hrs) AS max_resolution_time,
{cats},
    count(*) FILTER (WHERE ticket_date >= {AS_OF_SQL} - 90) AS recent_tickets
  FROM f_tickets WHERE ticket_date <= {AS_OF_SQL} GROUP BY customer_id),
o_base AS (
  SELECT customer_id, signup_date, age, gender, country, plan_type, monthly_fee,
    CAST({AS_OF_SQL} - signup_date AS INTEGER) AS tenure_days,
    CAST({AS_OF_SQL} - signup_date AS INTEGER) / 365.0 AS tenure_years,
    CAST(dense_rank() OVER (ORDER BY plan_type) - 1 AS INTEGER) AS plan_encoded,
    CAST(dense_rank() OVER (ORDER BY gender) - 1 AS INTEGER) AS gender_encoded,
{dummies}
  FROM f_customers),
o_join AS (
  SELECT b.*,
    CAST(coalesce(t.recency_days, 0) AS INTEGER) AS recency_days,
    CAST(coalesce(t.frequency, 0) AS BIGINT) AS frequency,
    coalesce(t.monetary, 0) AS monetary,
    coalesce(t.avg_txn_amount, 0) AS avg_txn_amount,
    coalesce(t.max_txn_amount, 0) AS max_txn_amount,
    coalesce(t.std_txn_amount, 0) AS std_txn_amount,
    CAST(coalesce(t.refund_count, 0) AS BIGINT) AS refund_count,
    coalesce(t.refund_total, 0) AS refund_total,
    CAST(coalesce(t.payment_method_count, 0) AS BIGINT) AS payment_method_count,
    CAST(coalesce(e.total_events, 0) AS BIGINT) AS total_events,
    CAST(coalesce(e.unique_event_types, 0) AS BIGINT) AS unique_event_types,
    coalesce(e.total_event_value, 0) AS total_event_value,
    coalesce(e.avg_event_value, 0) AS avg_event_value,
    coalesce(e.total_events / greatest(b.tenure_days, 1), 0) AS events_per_day,
    CAST(coalesce(e.active_days, 0) AS BIGINT) AS active_days,
    coalesce(e.active_days / greatest(b.tenure_days, 1), 0) AS active_days_ratio,
    CAST(coalesce(k.total_tickets, 0) AS BIGINT) AS total_tickets,
    coalesce(k.avg_resolution_time, 0) AS avg_resolution_time,
    coalesce(k.avg_satisfaction, 0) AS avg_satisfaction,
    CAST(coalesce(k.min_satisfaction, 0) AS INTEGER) AS min_satisfaction,
    coalesce(k.max_resolution_time, 0) AS max_resolution_time,
{",".join(chr(10) + f"    CAST(coalesce(k.tickets_{c}, 0) AS BIGINT) AS tickets_{c}" for c in TICKET_CATS)},
    CAST(coalesce(k.recent_tickets, 0) AS BIGINT) AS recent_tickets
  FROM o_base b
  LEFT JOIN o_txn t ON b.customer_id = t.customer_id
  LEFT JOIN o_ev e ON b.customer_id = e.customer_id
  LEFT JOIN o_tk k ON b.customer_id = k.customer_id),
feat AS (
  SELECT *,
    tenure_days * monthly_fee AS tenure_fee_interaction,
    total_events / (total_tickets + 1) AS events_per_ticket,
    avg_satisfaction / (total_tickets + 1) AS satisfaction_per_ticket,
    monetary / greatest(tenure_days, 1) AS monetary_per_tenure,
    avg_txn_amount / (events_per_day + 0.01) AS avg_txn_per_event
  FROM o_join)
"""


def with_features(*extra_views: str) -> str:
    return oracle_with("f_customers", "f_transactions", "f_events", "f_tickets", *extra_views) \
        + feature_ctes()


DOUBLE_FEATURES = [
    "monthly_fee", "tenure_years", "monetary", "avg_txn_amount", "max_txn_amount", "std_txn_amount",
    "refund_total", "total_event_value", "avg_event_value", "events_per_day", "active_days_ratio",
    "avg_resolution_time", "avg_satisfaction", "max_resolution_time", "tenure_fee_interaction",
    "events_per_ticket", "satisfaction_per_ticket", "monetary_per_tenure", "avg_txn_per_event"]


def select_rounded(cols: list[str], table: str = "feat") -> str:
    parts = [f"{R(c)} AS {c}" if c in DOUBLE_FEATURES else q(c) for c in cols]
    return "SELECT " + ", ".join(parts) + f" FROM {table}"
