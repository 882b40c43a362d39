"""Row filters.  Plain predicates on scan columns, so Catalyst pushes them into
the Parquet reader (``PushedFilters``) and prunes row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.dates import as_date


def positive_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.where(~F.col("is_refund"))


def refund_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.where(F.col("is_refund"))


def positive_value_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_value") > 0)


def recent_tickets(tickets: DataFrame, as_of="2024-12-31", days: int = 90) -> DataFrame:
    """Tickets dated within ``days`` days before ``as_of`` (inclusive)."""
    return tickets.where((F.col("ticket_date") >= F.date_sub(as_date(as_of), days))
                         & (F.col("ticket_date") <= as_date(as_of)))
