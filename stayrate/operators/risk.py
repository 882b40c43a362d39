"""Risk lists and retention findings as operators.

The reference states these as text (watch-lists, thresholds, findings); here
each is a query over the feature table, the activity tables or a score
column.  Where the text gives no exact definition, the one used is written in
the docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.bands import tenure_band
from stayrate.functions.dates import as_date
from stayrate.functions.numeric import money_avg
from stayrate.operators.quantiles import quantile_row
from stayrate.operators.common import scalars

# Fixed values named in the reference's risk text.
INACTIVE_DAYS = 30
LOW_ACTIVE_RATIO = 0.10
LOW_SATISFACTION = 3
SEVERAL_RECENT_TICKETS = 2
OUTREACH_THRESHOLD = 0.6
WINBACK_INACTIVE_DAYS = 14


def last_activity(transactions: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Latest transaction or event date per customer, on or before ``as_of``
    (one aggregate over the union of the two date columns)."""
    t = transactions.select("customer_id", F.col("transaction_date").alias("d"))
    e = events.select("customer_id", F.col("event_date").alias("d"))
    u = t.unionByName(e).where(F.col("d") <= as_date(as_of))
    return u.groupBy("customer_id").agg(F.max("d").alias("last_activity"))


def risk_flags(features: DataFrame, as_of, basic_plan: str = "Basic") -> DataFrame:
    """Five warning signs and their count per customer, from the feature table with its
    ``last_activity`` column (so the activity tables are read once).

    * inactive: more than 30 days since the later of last transaction and last
      event (customers without any activity count from signup),
    * low engagement: active-days ratio below 10 %,
    * low satisfaction: mean satisfaction below 3, only where tickets exist,
    * several recent tickets: 2 or more in the last 90 days,
    * basic plan.
    """
    since = F.datediff(as_date(as_of), F.coalesce(F.col("last_activity"), F.col("signup_date")))
    flags = {
        "flag_inactive": since > F.lit(INACTIVE_DAYS),
        "flag_low_engagement": F.col("active_days_ratio") < F.lit(LOW_ACTIVE_RATIO),
        "flag_low_satisfaction": (F.col("total_tickets") > 0)
                                 & (F.col("avg_satisfaction") < F.lit(LOW_SATISFACTION)),
        "flag_recent_tickets": F.col("recent_tickets") >= F.lit(SEVERAL_RECENT_TICKETS),
        "flag_basic_plan": F.col("plan_type") == F.lit(basic_plan),
    }
    out = features.select("customer_id", since.alias("days_since_activity"),
                    *[v.alias(k) for k, v in flags.items()])
    count = None
    for k in flags:
        term = F.col(k).cast("int")
        count = term if count is None else count + term
    return out.withColumn("risk_flag_count", count)


def inactive_customers(customers: DataFrame, transactions: DataFrame, events: DataFrame, as_of,
                       days: int = WINBACK_INACTIVE_DAYS) -> DataFrame:
    """Customers with no transaction or event in the last ``days`` days."""
    la = last_activity(transactions, events, as_of)
    df = customers.select("customer_id").join(la, "customer_id", "left")
    gap = F.datediff(as_date(as_of), F.col("last_activity"))
    return df.where(F.col("last_activity").isNull() | (gap > F.lit(days))) \
             .select("customer_id", "last_activity", gap.alias("days_inactive"))


def engagement_drop(events: DataFrame, as_of, window_days: int = 7, ratio: float = 0.5) -> DataFrame:
    """Customers whose events in the last ``window_days`` days fell below
    ``ratio`` times the count of the ``window_days`` days before."""
    end = as_date(as_of)
    recent_from = F.date_sub(end, window_days - 1)
    prev_from = F.date_sub(end, 2 * window_days - 1)
    e = events.where((F.col("event_date") >= prev_from) & (F.col("event_date") <= end))
    g = e.groupBy("customer_id").agg(
        F.count_if(F.col("event_date") >= recent_from).alias("events_recent"),
        F.count_if(F.col("event_date") < recent_from).alias("events_previous"))
    return g.where((F.col("events_previous") > 0)
                   & (F.col("events_recent") < F.lit(ratio) * F.col("events_previous")))


def outreach_list(scores: DataFrame, threshold: float = OUTREACH_THRESHOLD, score: str = "score") -> DataFrame:
    """Customers whose churn probability exceeds ``threshold``, highest first (ties by id)."""
    return (scores.where(F.col(score) > F.lit(threshold)).select("customer_id", score)
            .orderBy(F.desc(score), F.asc("customer_id")))


def high_risk_top(scores: DataFrame, n: int = 50, score: str = "score") -> DataFrame:
    """The weekly high-risk list: the ``n`` highest scores (ties by id)."""
    return scores.orderBy(F.desc(score), F.asc("customer_id")).limit(n).select("customer_id", score)


def churn_by_tenure_band(features: DataFrame, churn: DataFrame) -> DataFrame:
    """Churn rate (%) by tenure band (<= 90, <= 180, <= 365, > 365 days)."""
    df = features.select("customer_id", tenure_band("tenure_days").alias("tenure_band")) \
                 .join(churn, "customer_id")
    return df.groupBy("tenure_band").agg(F.count(F.lit(1)).alias("customers"),
                                         (F.avg(F.col("churn_30d").cast("double")) * 100).alias("churn_rate"))


def _top_flag(features: DataFrame, clv: DataFrame, q: float):
    df = features.join(clv, "customer_id")
    cut = scalars(quantile_row(clv, "clv", [q], ["cut"]))["cut"]
    return df.withColumn("value_group", F.when(F.col("clv") >= cut, F.lit("top")).otherwise(F.lit("rest")))


def high_value_profile(features: DataFrame, clv: DataFrame, q: float = 0.8) -> DataFrame:
    """Top clv quintile (clv at or above the exact 80th percentile) against
    the rest: size and mean profile."""
    df = _top_flag(features, clv, q)
    return df.groupBy("value_group").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("clv").alias("mean_clv"),
        F.avg("tenure_days").alias("mean_tenure_days"), F.avg("age").alias("mean_age"),
        F.avg("active_days_ratio").alias("mean_active_days_ratio"),
        F.avg("avg_satisfaction").alias("mean_satisfaction"),
        F.avg("total_tickets").alias("mean_tickets"), money_avg("monthly_fee").alias("mean_fee"))


def high_value_plan_share(features: DataFrame, clv: DataFrame, q: float = 0.8) -> DataFrame:
    """Share of each plan inside the top quintile and inside the rest."""
    df = _top_flag(features, clv, q)
    g = df.groupBy("value_group", "plan_type").agg(F.count(F.lit(1)).alias("customers"))
    # group sizes from the grouped frame itself (its exchange is reused)
    tot = g.groupBy("value_group").agg(F.sum("customers").alias("group_size"))
    return g.join(tot, "value_group").withColumn("share", F.col("customers") / F.col("group_size")) \
            .drop("group_size")
