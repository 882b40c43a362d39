"""Queries: filters, scalar expressions, joins and exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.functions.bands import age_band, fee_band
from stayrate.functions.dates import day_of_week, month_bucket
from stayrate.functions.numeric import inverse_log_target, log_target, round_half_up
from stayrate.operators import eda
from stayrate.operators import filters as fl
from stayrate.plans.registry import R, finish, register
from stayrate.sources.fixtures import AS_OF, fixture, oracle_with
from stayrate.sources.tables import parse_dates

A = "DATE '2001-12-31'"

AGE_CASE = ("CASE WHEN age > 17 AND age <= 25 THEN '18-25' WHEN age > 25 AND age <= 35 THEN '26-35' "
            "WHEN age > 35 AND age <= 45 THEN '36-45' WHEN age > 45 AND age <= 55 THEN '46-55' "
            "WHEN age > 55 AND age <= 65 THEN '56-65' WHEN age > 65 AND age <= 100 THEN '65+' END")
FEE_CASE = ("CASE WHEN monthly_fee > 0 AND monthly_fee <= 10 THEN '$0-10' "
            "WHEN monthly_fee > 10 AND monthly_fee <= 20 THEN '$10-20' "
            "WHEN monthly_fee > 20 AND monthly_fee <= 40 THEN '$20-40' "
            "WHEN monthly_fee > 40 AND monthly_fee <= 100 THEN '$40+' END")


# ------------------------------------------------------------------ filters
@register("positive_transactions", oracle_with("f_transactions") + f"""
SELECT customer_id, transaction_date, {R("amount")} AS amount, payment_method
FROM f_transactions WHERE NOT is_refund""")
def q_positive_transactions(spark, sf):
    return finish(fl.positive_transactions(fixture(spark, sf).transactions)
                  .select("customer_id", "transaction_date", "amount", "payment_method"))


@register("refund_transactions", oracle_with("f_transactions") + f"""
SELECT customer_id, transaction_date, {R("amount")} AS amount, payment_method
FROM f_transactions WHERE is_refund""")
def q_refund_transactions(spark, sf):
    return finish(fl.refund_transactions(fixture(spark, sf).transactions)
                  .select("customer_id", "transaction_date", "amount", "payment_method"))


@register("positive_value_events", oracle_with("f_events") + f"""
SELECT customer_id, event_date, event_type, {R("event_value")} AS event_value
FROM f_events WHERE event_value > 0""")
def q_positive_value_events(spark, sf):
    return finish(fl.positive_value_events(fixture(spark, sf).events))


@register("recent_tickets", oracle_with("f_tickets") + f"""
SELECT ticket_id, customer_id, ticket_date, ticket_category FROM f_tickets
WHERE ticket_date >= {A} - 90 AND ticket_date <= {A}""")
def q_recent_tickets(spark, sf):
    return fl.recent_tickets(fixture(spark, sf).support_tickets, AS_OF, 90) \
        .select("ticket_id", "customer_id", "ticket_date", "ticket_category")


@register("parse_dates", """
SELECT event_id, CAST(ts AS DATE) AS event_day, CAST(CAST(ts AS VARCHAR)[1:10] AS DATE) AS text_day
FROM events""")
def q_parse_dates(spark, sf):
    """Zone-less timestamps (read as timestamp_ntz) and 'yyyy-MM-dd' text to dates."""
    ev = fixture(spark, sf).raw("events")
    ev = ev.select("event_id", F.col("ts").alias("event_day"),
                   F.substring(F.col("ts").cast("string"), 1, 10).alias("text_day"))
    return parse_dates(parse_dates(ev, ["event_day"]), ["text_day"], "yyyy-MM-dd")


# ---------------------------------------------------------------- scalars
@register("age_fee_bands", oracle_with("f_customers") + f"""
SELECT customer_id, age, {AGE_CASE} AS age_group, {R("monthly_fee")} AS monthly_fee,
  {FEE_CASE} AS fee_group FROM f_customers""")
def q_age_fee_bands(spark, sf):
    c = fixture(spark, sf).customers
    return finish(c.select("customer_id", "age", age_band("age").alias("age_group"), "monthly_fee",
                           fee_band("monthly_fee").alias("fee_group")))


@register("day_of_week", oracle_with("f_transactions") + """
SELECT CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week, count(*) AS n_transactions
FROM f_transactions GROUP BY 1""")
def q_day_of_week(spark, sf):
    t = fixture(spark, sf).transactions
    return t.groupBy(day_of_week("transaction_date").alias("day_of_week")) \
        .agg(F.count(F.lit(1)).alias("n_transactions"))


@register("log_target", oracle_with("f_clv_labels") + f"""
SELECT customer_id, {R("clv")} AS clv, {R("ln(1 + clv)")} AS clv_log,
  {R("exp(ln(1 + clv)) - 1", 4)} AS clv_back FROM f_clv_labels""")
def q_log_target(spark, sf):
    """log1p target and its expm1 inverse (the inverse compared at money precision)."""
    c = fixture(spark, sf).clv_labels
    c = c.withColumn("clv_log", log_target("clv"))
    c = c.withColumn("clv_back", round_half_up(inverse_log_target("clv_log"), 4))
    return finish(c)


# ------------------------------------------------------------------ joins
@register("customers_with_clv", oracle_with("f_customers", "f_clv_labels") + f"""
SELECT c.customer_id, c.plan_type, c.age, {R("l.clv")} AS clv
FROM f_customers c JOIN f_clv_labels l ON c.customer_id = l.customer_id""")
def q_customers_with_clv(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.customers_with_clv(fx.customers, fx.clv_labels)
                  .select("customer_id", "plan_type", "age", "clv"))


@register("customers_with_churn", oracle_with("f_customers", "f_churn_labels") + """
SELECT c.customer_id, c.plan_type, c.country, l.churn_30d
FROM f_customers c JOIN f_churn_labels l ON c.customer_id = l.customer_id""")
def q_customers_with_churn(spark, sf):
    fx = fixture(spark, sf)
    return eda.customers_with_churn(fx.customers, fx.churn_labels) \
        .select("customer_id", "plan_type", "country", "churn_30d")


@register("transactions_with_customers", oracle_with("f_transactions") + f"""
SELECT t.customer_id, t.transaction_date, {R("t.amount")} AS amount, t.is_refund,
  c.signup_date, c.plan_type, {R("c.monthly_fee")} AS monthly_fee
FROM f_transactions t JOIN f_customers c ON t.customer_id = c.customer_id""")
def q_transactions_with_customers(spark, sf):
    fx = fixture(spark, sf)
    j = eda.transactions_with_customers(fx.transactions, fx.customers)
    return finish(j.select("customer_id", "transaction_date", "amount", "is_refund", "signup_date",
                           "plan_type", "monthly_fee"))


@register("events_with_plan", oracle_with("f_events", "f_customers") + """
SELECT e.customer_id, e.event_date, e.event_type, c.plan_type
FROM f_events e JOIN f_customers c ON e.customer_id = c.customer_id""")
def q_events_with_plan(spark, sf):
    fx = fixture(spark, sf)
    return eda.events_with_plan(fx.events, fx.customers) \
        .select("customer_id", "event_date", "event_type", "plan_type")


@register("tickets_with_plan", oracle_with("f_tickets") + """
SELECT t.ticket_id, t.customer_id, t.ticket_category, c.plan_type
FROM f_tickets t JOIN f_customers c ON t.customer_id = c.customer_id""")
def q_tickets_with_plan(spark, sf):
    fx = fixture(spark, sf)
    return eda.tickets_with_plan(fx.support_tickets, fx.customers) \
        .select("ticket_id", "customer_id", "ticket_category", "plan_type")


@register("event_count_by_label", oracle_with("f_events", "f_churn_labels") + """
SELECT e.customer_id, count(*) AS event_count, l.churn_30d
FROM f_events e JOIN f_churn_labels l ON e.customer_id = l.customer_id
GROUP BY e.customer_id, l.churn_30d""")
def q_event_count_by_label(spark, sf):
    fx = fixture(spark, sf)
    return eda.event_count_by_label(fx.events, fx.churn_labels) \
        .select("customer_id", "event_count", "churn_30d")


# ------------------------------------------------------------- aggregates
def _churn_sql(dim_expr: str, dim: str) -> str:
    return oracle_with("f_customers", "f_churn_labels") + f"""
SELECT {dim_expr} AS {dim}, count(*) AS customers,
  {R("avg(CAST(l.churn_30d AS DOUBLE)) * 100.0")} AS churn_rate
FROM f_customers c JOIN f_churn_labels l ON c.customer_id = l.customer_id
WHERE {dim_expr} IS NOT NULL GROUP BY 1"""


def _churn_frame(spark, sf):
    fx = fixture(spark, sf)
    return eda.with_bands(eda.customers_with_churn(fx.customers, fx.churn_labels))


for _dim, _expr in [("plan_type", "c.plan_type"), ("country", "c.country"), ("gender", "c.gender"),
                    ("age_group", AGE_CASE.replace("age", "c.age").replace("c.age_group", "age_group")),
                    ("fee_group", FEE_CASE.replace("monthly_fee", "c.monthly_fee"))]:
    def _mk(dim):
        def q(spark, sf):
            return finish(eda.churn_rate_by(_churn_frame(spark, sf), dim))
        q.__doc__ = f"Churn rate (%) by {dim}."
        return q
    register(f"churn_rate_by_{_dim}", _churn_sql(_expr, _dim))(_mk(_dim))


@register("overall_churn", oracle_with("f_churn_labels") + f"""
SELECT {R("avg(CAST(churn_30d AS DOUBLE))")} AS churn_rate, CAST(sum(churn_30d) AS BIGINT) AS churners,
  count(*) AS customers FROM f_churn_labels""")
def q_overall_churn(spark, sf):
    return finish(eda.overall_churn(fixture(spark, sf).churn_labels))


@register("clv_by_plan", oracle_with("f_customers", "f_clv_labels") + f"""
SELECT c.plan_type, {R("avg(l.clv)")} AS mean_clv
FROM f_customers c JOIN f_clv_labels l ON c.customer_id = l.customer_id GROUP BY 1""")
def q_clv_by_plan(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.clv_by_plan(eda.customers_with_clv(fx.customers, fx.clv_labels)))


@register("kpi_overview", oracle_with("f_customers", "f_churn_labels", "f_clv_labels") + f"""
SELECT (SELECT count(*) FROM f_customers) AS total_customers,
  {R("(SELECT CAST(sum(CAST(monthly_fee AS DECIMAL(18,4))) AS DOUBLE) / count(monthly_fee) FROM f_customers)")} AS avg_monthly_fee,
  {R("(SELECT avg(CAST(churn_30d AS DOUBLE)) FROM f_churn_labels)")} AS churn_rate,
  {R("(SELECT avg(clv) FROM f_clv_labels)")} AS avg_clv,
  (SELECT avg(CAST(churn_30d AS DOUBLE)) FROM f_churn_labels) > 0.1 AS churn_alert""")
def q_kpi_overview(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.kpi_overview(fx.customers, fx.churn_labels, fx.clv_labels))


@register("refund_rate", oracle_with("f_transactions") + f"""
SELECT {R("avg(CAST(is_refund AS DOUBLE)) * 100.0")} AS refund_rate, count(*) AS transactions
FROM f_transactions""")
def q_refund_rate(spark, sf):
    return finish(eda.refund_rate(fixture(spark, sf).transactions))


@register("monthly_volume_transactions", oracle_with("f_transactions") + """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, count(*) AS n_rows
FROM f_transactions GROUP BY 1""")
def q_monthly_volume_transactions(spark, sf):
    return eda.monthly_volume(fixture(spark, sf).transactions, "transaction_date")


@register("monthly_volume_events", oracle_with("f_events") + """
SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, count(*) AS n_rows
FROM f_events GROUP BY 1""")
def q_monthly_volume_events(spark, sf):
    return eda.monthly_volume(fixture(spark, sf).events, "event_date")


@register("month_bucket", oracle_with("f_tickets") + """
SELECT ticket_id, CAST(date_trunc('month', ticket_date) AS DATE) AS month FROM f_tickets""")
def q_month_bucket(spark, sf):
    t = fixture(spark, sf).support_tickets
    return t.select("ticket_id", month_bucket("ticket_date").alias("month"))


@register("avg_amount_by_plan", oracle_with("f_transactions") + f"""
SELECT c.plan_type, {R("CAST(sum(CAST(t.amount AS DECIMAL(18,4))) AS DOUBLE) / count(t.amount)")}
  AS avg_amount, count(*) AS transactions
FROM f_transactions t JOIN f_customers c ON t.customer_id = c.customer_id GROUP BY 1""")
def q_avg_amount_by_plan(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.avg_amount_by_plan(eda.transactions_with_customers(fx.transactions, fx.customers)))


@register("satisfaction_by_category", oracle_with("f_tickets") + f"""
SELECT ticket_category, {R("avg(satisfaction_score)")} AS avg_satisfaction, count(*) AS tickets
FROM f_tickets GROUP BY 1""")
def q_satisfaction_by_category(spark, sf):
    return finish(eda.satisfaction_by_category(fixture(spark, sf).support_tickets))


@register("satisfaction_counts", oracle_with("f_tickets") + """
SELECT satisfaction_score, count(*) AS n_tickets FROM f_tickets GROUP BY 1""")
def q_satisfaction_counts(spark, sf):
    return eda.satisfaction_counts(fixture(spark, sf).support_tickets)


@register("avg_events_by_churn", oracle_with("f_events", "f_churn_labels") + f"""
SELECT churn_30d, {R("avg(event_count)")} AS avg_events, count(*) AS customers FROM (
  SELECT e.customer_id, count(*) AS event_count, l.churn_30d
  FROM f_events e JOIN f_churn_labels l ON e.customer_id = l.customer_id
  GROUP BY e.customer_id, l.churn_30d) GROUP BY churn_30d""")
def q_avg_events_by_churn(spark, sf):
    fx = fixture(spark, sf)
    return finish(eda.avg_events_by_churn(fx.events, fx.churn_labels))


ACTIVITY_SQL = f""",
a_t AS (SELECT customer_id, count(amount) AS txn_count,
          CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) AS txn_total,
          CAST(sum(CAST(amount AS DECIMAL(18,4))) AS DOUBLE) / count(amount) AS txn_avg,
          count(*) FILTER (WHERE is_refund) AS refund_count
        FROM f_transactions GROUP BY customer_id),
a_e AS (SELECT customer_id, count(event_type) AS event_count, sum(event_value) AS event_value_total
        FROM f_events GROUP BY customer_id),
a_k AS (SELECT customer_id, count(ticket_id) AS ticket_count,
          avg(resolution_time_hrs) AS avg_resolution_time, avg(satisfaction_score) AS avg_satisfaction
        FROM f_tickets GROUP BY customer_id),
act AS (
  SELECT c.customer_id, c.age, c.monthly_fee, CAST({A} - c.signup_date AS INTEGER) AS tenure_days,
    CAST(coalesce(t.txn_count, 0) AS BIGINT) AS txn_count, coalesce(t.txn_total, 0) AS txn_total,
    coalesce(t.txn_avg, 0) AS txn_avg, CAST(coalesce(t.refund_count, 0) AS BIGINT) AS refund_count,
    CAST(coalesce(e.event_count, 0) AS BIGINT) AS event_count,
    coalesce(e.event_value_total, 0) AS event_value_total,
    CAST(coalesce(k.ticket_count, 0) AS BIGINT) AS ticket_count,
    coalesce(k.avg_resolution_time, 0) AS avg_resolution_time,
    coalesce(k.avg_satisfaction, 0) AS avg_satisfaction,
    coalesce(v.clv, 0) AS clv, coalesce(h.churn_30d, 0) AS churn_30d
  FROM f_customers c LEFT JOIN a_t t ON c.customer_id = t.customer_id
  LEFT JOIN a_e e ON c.customer_id = e.customer_id LEFT JOIN a_k k ON c.customer_id = k.customer_id
  LEFT JOIN f_clv_labels v ON c.customer_id = v.customer_id
  LEFT JOIN f_churn_labels h ON c.customer_id = h.customer_id)
"""
ACTIVITY_COLS = ["customer_id", "age", "monthly_fee", "tenure_days", "txn_count", "txn_total", "txn_avg",
                 "refund_count", "event_count", "event_value_total", "ticket_count",
                 "avg_resolution_time", "avg_satisfaction", "clv", "churn_30d"]
ACTIVITY_DOUBLES = {"monthly_fee", "txn_total", "txn_avg", "event_value_total", "avg_resolution_time",
                    "avg_satisfaction", "clv"}


def activity_df(spark, sf):
    fx = fixture(spark, sf)
    return eda.basic_activity_stats(fx.customers, fx.transactions, fx.events, fx.support_tickets,
                                    fx.clv_labels, fx.churn_labels, AS_OF)


@register("basic_activity_stats",
          oracle_with("f_customers", "f_transactions", "f_events", "f_tickets", "f_clv_labels",
                      "f_churn_labels") + ACTIVITY_SQL + "SELECT " +
          ", ".join(f"{R(c)} AS {c}" if c in ACTIVITY_DOUBLES else c for c in ACTIVITY_COLS) + " FROM act")
def q_basic_activity_stats(spark, sf):
    return finish(activity_df(spark, sf).select(*ACTIVITY_COLS))


def _vc_sql(view: str, col: str, top: int | None = None) -> str:
    lim = f" ORDER BY count DESC, value LIMIT {top}" if top else ""
    return oracle_with(view) + f"""
SELECT CAST({col} AS VARCHAR) AS value, count(*) AS count,
  {R("count(*) / sum(count(*)) OVER ()")} AS share
FROM {view} WHERE {col} IS NOT NULL GROUP BY {col}{lim}"""


for _name, _view, _role, _col, _top in [
        ("gender", "f_customers", "customers", "gender", None),
        ("plan_type", "f_customers", "customers", "plan_type", None),
        ("country_top10", "f_customers", "customers", "country", 10),
        ("churn", "f_churn_labels", "churn_labels", "churn_30d", None),
        ("payment_method", "f_transactions", "transactions", "payment_method", None),
        ("event_type", "f_events", "events", "event_type", None),
        ("ticket_category", "f_tickets", "support_tickets", "ticket_category", None)]:
    def _mk(role, col, top):
        def q(spark, sf):
            vc = eda.value_counts(getattr(fixture(spark, sf), role), col, True, top)
            return finish(vc.select(F.col(col).cast("string").alias("value"), "count", "share"))
        q.__doc__ = f"value_counts of {col}" + (f", top {top}" if top else "")
        return q
    register(f"value_counts_{_name}", _vc_sql(_view, _col, _top))(_mk(_role, _col, _top))
