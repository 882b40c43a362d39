"""Point-in-time per-customer feature table.

Every activity table is aggregated once per customer with conditional
aggregates (one scan each instead of one per feature group), then joined to
customers on ``customer_id``.  Partial aggregation runs map-side, so a customer
holding a large share of the rows sends one partial row per task into the
shuffle; the joins are one-to-one on the aggregated key.

Only rows dated on or before ``as_of`` are read, so rows from after the
prediction date cannot leak into the features.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.dates import as_date, tenure_days
from stayrate.functions.encoding import encode_with_levels, fit_levels, label_encode
from stayrate.functions.numeric import clip_lower, money_sum, safe_div

DEFAULT_AS_OF = "2024-12-31"
RECENT_TICKET_DAYS = 90
# The reference's ticket categories (its pivot columns, sorted).
TICKET_CATEGORIES = ["account", "billing", "cancellation", "feature_request", "technical"]
RAW_COLUMNS = ["customer_id", "signup_date", "plan_type", "gender", "country"]
# Columns handed to the models are the feature table minus these.
IDENTITY_COLUMNS = ["customer_id", "signup_date", "plan_type", "gender", "country"]


def _on_or_before(df: DataFrame, date_col: str, as_of) -> DataFrame:
    return df.where(F.col(date_col) <= as_date(as_of))


def _if(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


# ---------------------------------------------------------------- per table
def rfm(transactions: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    """Recency / frequency / monetary over non-refund transactions."""
    pos = _on_or_before(transactions.where(~F.col("is_refund")), "transaction_date", as_of)
    return pos.groupBy("customer_id").agg(
        F.datediff(as_date(as_of), F.max("transaction_date")).alias("recency_days"),
        F.count("transaction_date").alias("frequency"),
        money_sum("amount").alias("monetary"),
        safe_div(money_sum("amount"), F.count("amount")).alias("avg_txn_amount"),
        F.max("amount").alias("max_txn_amount"),
        F.stddev_samp("amount").alias("std_txn_amount"),
    )


def refund_stats(transactions: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    ref = _on_or_before(transactions.where(F.col("is_refund")), "transaction_date", as_of)
    return ref.groupBy("customer_id").agg(
        F.count("amount").alias("refund_count"),
        money_sum("amount").alias("refund_total"),
    )


def payment_diversity(transactions: DataFrame, as_of=DEFAULT_AS_OF) -> DataFrame:
    t = _on_or_before(transactions, "transaction_date", as_of)
    return t.groupBy("customer_id").agg(
        F.countDistinct("payment_method").alias("payment_method_count"))


def txn_features(transactions: DataFrame, as_of=DEFAULT_AS_OF, *more: F.Column) -> DataFrame:
    """``rfm`` + ``refund_stats`` + ``payment_diversity`` (and ``more`` aggregates) in one pass.

    Customers with refunds only get ``frequency = 0`` and NULL recency /
    monetary, which the feature table fills like the reference's left join.
    """
    t = _on_or_before(transactions, "transaction_date", as_of)
    pos = ~F.col("is_refund")
    neg = F.col("is_refund")
    pos_amount = _if(pos, F.col("amount"))
    return t.groupBy("customer_id").agg(
        F.datediff(as_date(as_of), F.max(_if(pos, F.col("transaction_date")))).alias("recency_days"),
        F.count_if(pos).alias("frequency"),
        money_sum(pos_amount).alias("monetary"),
        safe_div(money_sum(pos_amount), F.count(pos_amount)).alias("avg_txn_amount"),
        F.max(pos_amount).alias("max_txn_amount"),
        F.stddev_samp(pos_amount).alias("std_txn_amount"),
        F.count_if(neg).alias("refund_count"),
        money_sum(_if(neg, F.col("amount"))).alias("refund_total"),
        F.countDistinct("payment_method").alias("payment_method_count"),
        *more,
    )


def _distinct(c) -> F.Column:
    """Exact number of different values of a column with few (days, kinds): the sets merge on the
    way, and unlike two ``countDistinct`` they keep the rows' partitioning by customer."""
    return F.size(F.collect_set(c)).cast("long")


def event_stats(events: DataFrame, as_of=DEFAULT_AS_OF, *more: F.Column) -> DataFrame:
    """Event volume, diversity, value and distinct active days per customer (and ``more`` aggregates)."""
    e = _on_or_before(events, "event_date", as_of)
    return e.groupBy("customer_id").agg(
        F.count("event_type").alias("total_events"),
        _distinct("event_type").alias("unique_event_types"),
        F.sum("event_value").alias("total_event_value"),
        F.avg("event_value").alias("avg_event_value"),
        _distinct(F.col("event_date").cast("date")).alias("active_days"),
        *more,
    )


def ticket_stats(tickets: DataFrame, as_of=DEFAULT_AS_OF,
                 categories: Sequence[str] = TICKET_CATEGORIES,
                 recent_days: int = RECENT_TICKET_DAYS) -> DataFrame:
    """Ticket volume, resolution, satisfaction, per-category counts (the pivot,
    written as conditional counts over an explicit value list) and the count
    in the last ``recent_days`` days."""
    t = _on_or_before(tickets, "ticket_date", as_of)
    recent_from = F.date_sub(as_date(as_of), recent_days)
    pivot = [F.count_if(F.col("ticket_category") == F.lit(c)).alias(f"tickets_{c}")
             for c in sorted(categories)]
    return t.groupBy("customer_id").agg(
        F.count("ticket_id").alias("total_tickets"),
        F.avg("resolution_time_hrs").alias("avg_resolution_time"),
        F.avg("satisfaction_score").alias("avg_satisfaction"),
        F.min("satisfaction_score").alias("min_satisfaction"),
        F.max("resolution_time_hrs").alias("max_resolution_time"),
        *pivot,
        F.count_if(F.col("ticket_date") >= recent_from).alias("recent_tickets"),
    )


def ticket_category_pivot(tickets: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """``groupBy.pivot(category).count`` with an explicit value list; absent cells 0."""
    cats = sorted(categories or TICKET_CATEGORIES)
    p = tickets.groupBy("customer_id").pivot("ticket_category", cats).count()
    return p.select("customer_id", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(f"tickets_{c}")
                                     for c in cats])


def recent_ticket_count(tickets: DataFrame, as_of=DEFAULT_AS_OF,
                        days: int = RECENT_TICKET_DAYS) -> DataFrame:
    t = tickets.where((F.col("ticket_date") >= F.date_sub(as_date(as_of), days))
                      & (F.col("ticket_date") <= as_date(as_of)))
    return t.groupBy("customer_id").agg(F.count("ticket_id").alias("recent_tickets"))


# ------------------------------------------------------------ feature table
def interaction_features(df: DataFrame) -> DataFrame:
    """The five ratio / product features (after nulls were filled)."""
    tenure1 = clip_lower("tenure_days", 1)
    return df.withColumns({
        "tenure_fee_interaction": F.col("tenure_days") * F.col("monthly_fee"),
        "events_per_ticket": F.col("total_events") / (F.col("total_tickets") + F.lit(1)),
        "satisfaction_per_ticket": F.col("avg_satisfaction") / (F.col("total_tickets") + F.lit(1)),
        "monetary_per_tenure": F.col("monetary") / tenure1,
        "avg_txn_per_event": F.col("avg_txn_amount") / (F.col("events_per_day") + F.lit(0.01)),
    })


NUMERIC_TYPES = {"int", "bigint", "double", "float", "smallint", "tinyint"}


def fill_numeric_nulls(df: DataFrame, keep: Sequence[str] = RAW_COLUMNS, value=0) -> DataFrame:
    """0 in every numeric column except the raw identity columns."""
    cols = [c for c, t in df.dtypes if c not in keep and (t in NUMERIC_TYPES or t.startswith("decimal"))]
    return df.fillna(value, subset=cols)


def customer_features(customers: DataFrame, transactions: DataFrame, events: DataFrame,
                      tickets: DataFrame, as_of=DEFAULT_AS_OF, fill: str = "zero",
                      countries: Sequence[str] | None = None,
                      ticket_categories: Sequence[str] = TICKET_CATEGORIES,
                      last_activity: bool = False) -> DataFrame:
    """One row per customer, 51 columns (with 8 countries; one dummy per country).

    ``fill="zero"`` reproduces the reference (every missing numeric -> 0, so a
    customer without purchases gets recency 0).  ``fill="tenure"`` sets the
    recency of such customers to their tenure and adds ``has_txn`` /
    ``has_tickets`` flags.  ``last_activity`` adds the date of the later of last
    transaction and last event, from the same aggregates.

    Plan shape: three per-customer aggregates left-joined to the customer
    base, then a single projection that fills, derives and orders every
    column (one plan step instead of one per feature group).
    """
    levels = fit_levels(customers, ["plan_type", "gender"] + ([] if countries is not None else ["country"]))
    country_levels = sorted(countries) if countries is not None else levels["country"]
    if country_levels is None:
        raise ValueError("too many countries for a column each: pass the ones wanted, or use one_hot_vector")
    given = customers.columns
    for c in ("plan_type", "gender"):
        if levels[c] is None:  # too many for a constant: joined from a distributed dictionary
            customers = label_encode(customers, c, f"_{c}_code")
    code = {c: encode_with_levels(c, levels[c]) if levels[c] is not None else F.when(F.col(c).isNotNull(), F.col(f"_{c}_code"))
            for c in ("plan_type", "gender")}
    tenure = tenure_days("signup_date", as_of)
    base = customers.select(
        *given, tenure.alias("tenure_days"),
        (tenure / F.lit(365.0)).alias("tenure_years"),
        code["plan_type"].alias("plan_encoded"), code["gender"].alias("gender_encoded"),
        *[(F.col("country") == F.lit(v)).cast("int").alias(f"country_{v}") for v in country_levels])

    last = [[F.max(d).alias(f"_last_{d}")] if last_activity else [] for d in ("transaction_date", "event_date")]
    txn = txn_features(transactions, as_of, *last[0])
    ev = event_stats(events, as_of, *last[1])
    tk = ticket_stats(tickets, as_of, ticket_categories)
    df = base.join(txn, "customer_id", "left").join(ev, "customer_id", "left") \
             .join(tk, "customer_id", "left")

    if fill == "tenure":
        df = df.withColumns({"has_txn": F.coalesce(F.col("frequency") > 0, F.lit(False)),
                             "has_tickets": F.col("total_tickets").isNotNull(),
                             "recency_days": F.coalesce("recency_days", "tenure_days")})
    df = fill_numeric_nulls(df)
    # Per-day rates divide after the join: each customer's own tenure.
    df = df.withColumns({"events_per_day": F.col("total_events") / clip_lower("tenure_days", 1),
                         "active_days_ratio": F.col("active_days") / clip_lower("tenure_days", 1)})
    df = interaction_features(df)
    order = (["customer_id", "signup_date", "age", "gender", "country", "plan_type", "monthly_fee",
              "tenure_days", "tenure_years", "plan_encoded", "gender_encoded"] +
             [f"country_{v}" for v in country_levels] +
             ["recency_days", "frequency", "monetary", "avg_txn_amount", "max_txn_amount",
              "std_txn_amount", "refund_count", "refund_total", "payment_method_count",
              "total_events", "unique_event_types", "total_event_value", "avg_event_value",
              "events_per_day", "active_days", "active_days_ratio",
              "total_tickets", "avg_resolution_time", "avg_satisfaction", "min_satisfaction",
              "max_resolution_time"] +
             [f"tickets_{c}" for c in sorted(ticket_categories)] +
             ["recent_tickets", "tenure_fee_interaction", "events_per_ticket",
              "satisfaction_per_ticket", "monetary_per_tenure", "avg_txn_per_event"])
    latest = [F.greatest("_last_transaction_date", "_last_event_date").alias("last_activity")] if last_activity else []
    return df.select(*order, *(["has_txn", "has_tickets"] if fill == "tenure" else []), *latest)


def model_columns(features: DataFrame, drop: Sequence[str] = IDENTITY_COLUMNS) -> list[str]:
    """Numeric model inputs: the feature table minus id / date / raw strings."""
    return [c for c in features.columns if c not in drop]


def drop_identity_columns(df: DataFrame, keep_key: bool = False) -> DataFrame:
    cols = [c for c in IDENTITY_COLUMNS if c in df.columns and not (keep_key and c == "customer_id")]
    return df.drop(*cols)
