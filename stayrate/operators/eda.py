"""Exploratory aggregates: churn and value by dimension, volumes, KPIs.

All are ``groupBy`` aggregates with map-side partial aggregation.  Global
totals (shares, KPI values) are single scalar subqueries (``DataFrame.scalar()``):
they run once and are folded into the plan, no join and no driver round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.bands import age_band, fee_band
from stayrate.functions.dates import month_bucket
from stayrate.functions.numeric import money_avg, rate_percent, safe_div
from stayrate.operators.common import scalars

CHURN = "churn_30d"


# ------------------------------------------------------------------ joins
def customers_with_clv(customers: DataFrame, clv: DataFrame) -> DataFrame:
    """Inner join on ``customer_id``; AQE broadcasts the smaller side only when
    its measured size is under the broadcast threshold."""
    return customers.join(clv, "customer_id", "inner")


def customers_with_churn(customers: DataFrame, churn: DataFrame) -> DataFrame:
    return customers.join(churn, "customer_id", "inner")


def transactions_with_customers(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions plus signup date, plan and fee (right side projected first)."""
    return transactions.join(customers.select("customer_id", "signup_date", "plan_type", "monthly_fee"),
                             "customer_id", "inner")


def events_with_plan(events: DataFrame, customers: DataFrame) -> DataFrame:
    return events.join(customers.select("customer_id", "plan_type"), "customer_id", "inner")


def tickets_with_plan(tickets: DataFrame, customers: DataFrame) -> DataFrame:
    return tickets.join(customers.select("customer_id", "plan_type"), "customer_id", "inner")


def attach_labels(features: DataFrame, *labels: DataFrame, how: str = "inner") -> DataFrame:
    out = features
    for lab in labels:
        out = out.join(lab, "customer_id", how)
    return out


def event_count_by_label(events: DataFrame, churn: DataFrame) -> DataFrame:
    """Events per customer (aggregated first), then joined to the label."""
    per = events.groupBy("customer_id").agg(F.count(F.lit(1)).alias("event_count"))
    return per.join(churn, "customer_id", "inner")


# ------------------------------------------------------------- aggregates
def churn_rate_by(df_churn: DataFrame, dim: str, label: str = CHURN) -> DataFrame:
    """Churn rate in percent per value of ``dim``, highest first (NULL groups
    dropped, as pandas does)."""
    rates = (df_churn.where(F.col(dim).isNotNull()).groupBy(dim)
             .agg(F.count(F.lit(1)).alias("customers"), rate_percent(label).alias("churn_rate")))
    return rates.orderBy(F.desc("churn_rate"), dim)


def with_bands(df: DataFrame) -> DataFrame:
    """Adds ``age_group`` / ``fee_group`` (right-closed, NULL outside)."""
    return df.withColumns({"age_group": age_band("age"), "fee_group": fee_band("monthly_fee")})


def overall_churn(churn: DataFrame, label: str = CHURN) -> DataFrame:
    return churn.agg(F.avg(F.col(label).cast("double")).alias("churn_rate"),
                     F.sum(label).cast("bigint").alias("churners"),
                     F.count(F.lit(1)).alias("customers"))


def clv_by_plan(df_clv: DataFrame) -> DataFrame:
    """Mean clv per plan, lowest first."""
    return df_clv.groupBy("plan_type").agg(F.avg("clv").alias("mean_clv")).orderBy("mean_clv", "plan_type")


def kpi_overview(customers: DataFrame, churn: DataFrame, clv: DataFrame,
                 alert_rate: float = 0.10) -> DataFrame:
    """Customers, mean fee, churn rate, mean clv and a red flag above
    ``alert_rate``.  Three independent global aggregates; one output row."""
    c = customers.agg(F.count(F.lit(1)).alias("n"), money_avg("monthly_fee").alias("fee"))
    rate = churn.select(F.avg(F.col(CHURN).cast("double"))).scalar()
    mean_clv = clv.select(F.avg("clv")).scalar()
    return c.select(F.col("n").alias("total_customers"), F.col("fee").alias("avg_monthly_fee"),
                    rate.alias("churn_rate"), mean_clv.alias("avg_clv"),
                    (rate > F.lit(alert_rate)).alias("churn_alert"))


def refund_rate(transactions: DataFrame) -> DataFrame:
    return transactions.agg(rate_percent("is_refund").alias("refund_rate"),
                            F.count(F.lit(1)).alias("transactions"))


def monthly_volume(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per calendar month (months without rows are absent)."""
    return df.groupBy(month_bucket(date_col).alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


def avg_amount_by_plan(txn_with_customers: DataFrame) -> DataFrame:
    return txn_with_customers.groupBy("plan_type").agg(money_avg("amount").alias("avg_amount"),
                                                       F.count(F.lit(1)).alias("transactions"))


def satisfaction_by_category(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("ticket_category").agg(F.avg("satisfaction_score").alias("avg_satisfaction"),
                                                  F.count(F.lit(1)).alias("tickets")) \
        .orderBy("avg_satisfaction", "ticket_category")


def satisfaction_counts(tickets: DataFrame) -> DataFrame:
    """Tickets per score, in score order."""
    return tickets.groupBy("satisfaction_score").agg(F.count(F.lit(1)).alias("n_tickets")).orderBy("satisfaction_score")


def avg_events_by_churn(events: DataFrame, churn: DataFrame, label: str = CHURN) -> DataFrame:
    per = event_count_by_label(events, churn)
    return per.groupBy(label).agg(F.avg("event_count").alias("avg_events"),
                                  F.count(F.lit(1)).alias("customers"))


def basic_activity_stats(customers: DataFrame, transactions: DataFrame, events: DataFrame,
                         tickets: DataFrame, clv: DataFrame, churn: DataFrame,
                         as_of: str = "2024-12-31") -> DataFrame:
    """The notebook's correlation input: plain per-customer activity totals
    over all transactions (refunds included), left-joined and 0-filled."""
    t = transactions.groupBy("customer_id").agg(
        F.count("amount").alias("txn_count"),
        F.sum(F.col("amount").cast("decimal(18,4)")).cast("double").alias("txn_total"),
        money_avg("amount").alias("txn_avg"),
        F.count_if("is_refund").alias("refund_count"))
    e = events.groupBy("customer_id").agg(F.count("event_type").alias("event_count"),
                                          F.sum("event_value").alias("event_value_total"))
    k = tickets.groupBy("customer_id").agg(F.count("ticket_id").alias("ticket_count"),
                                           F.avg("resolution_time_hrs").alias("avg_resolution_time"),
                                           F.avg("satisfaction_score").alias("avg_satisfaction"))
    base = customers.select("customer_id", "age", "monthly_fee",
                            F.datediff(F.lit(as_of).cast("date"), "signup_date").alias("tenure_days"))
    out = (base.join(t, "customer_id", "left").join(e, "customer_id", "left")
           .join(k, "customer_id", "left").join(clv, "customer_id", "left")
           .join(churn, "customer_id", "left"))
    return out.fillna(0)


def value_counts(df: DataFrame, col: str, normalize: bool = True, top: int | None = None) -> DataFrame:
    """Frequency of each value, descending (ties by value), with its share of
    all non-null rows; ``top`` keeps the first n (the report's head(10))."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        # a scalar subquery on the grouped frame: its exchange is reused
        total = counts.select(F.sum("count")).scalar()
        counts = counts.withColumn("share", F.col("count") / total)
    counts = counts.orderBy(F.desc("count"), F.asc(col))
    return counts if top is None else counts.limit(top)


def churn_by_satisfaction_band(features: DataFrame, churn: DataFrame, cut: float = 3.0) -> DataFrame:
    """Churn rate for customers with tickets and mean satisfaction < ``cut``
    versus >= ``cut``, and the ratio low / high."""
    df = features.where(F.col("total_tickets") > 0).join(churn, "customer_id")
    band = F.when(F.col("avg_satisfaction") < F.lit(cut), F.lit("low")).otherwise(F.lit("high"))
    g = df.groupBy(band.alias("satisfaction_band")).agg(
        F.count(F.lit(1)).alias("customers"), F.avg(F.col(CHURN).cast("double")).alias("churn_rate"))
    r = scalars(g.agg(F.max(F.when(F.col("satisfaction_band") == "low", F.col("churn_rate"))).alias("low"),
                      F.max(F.when(F.col("satisfaction_band") == "high", F.col("churn_rate"))).alias("high")))
    return g.withColumn("low_to_high_ratio", safe_div(r["low"], r["high"]))


def value_and_churn_by_refunds(features: DataFrame, clv: DataFrame, churn: DataFrame) -> DataFrame:
    band = (F.when(F.col("refund_count") == 0, F.lit("0"))
            .when(F.col("refund_count") == 1, F.lit("1")).otherwise(F.lit("2+")))
    df = features.select("customer_id", band.alias("refund_band")) \
        .join(clv, "customer_id").join(churn, "customer_id")
    return df.groupBy("refund_band").agg(F.count(F.lit(1)).alias("customers"),
                                         F.avg("clv").alias("mean_clv"),
                                         F.avg(F.col(CHURN).cast("double")).alias("churn_rate"))


def sort_by_customer_date(df: DataFrame, date_col: str) -> DataFrame:
    """Rows ordered by customer, then date, then the other columns (a
    range-partitioned global sort)."""
    return df.orderBy("customer_id", date_col, *[c for c in df.columns if c not in ("customer_id", date_col)])
