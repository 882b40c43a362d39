"""Date expressions.  Day differences count calendar days between dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> Column:
    """A date literal from ``'yyyy-MM-dd'`` / ``datetime.date``, or a column as date."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end``; timestamps are cast to date first."""
    return F.datediff(as_date(end) if not isinstance(end, str) else F.col(end).cast("date"),
                      _col(start).cast("date"))


def tenure_days(signup="signup_date", as_of="2024-12-31") -> Column:
    return F.datediff(as_date(as_of), _col(signup).cast("date"))


def tenure_years(days="tenure_days") -> Column:
    return _col(days) / F.lit(365.0)


def day_of_week(c) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_col(c))


def month_bucket(c) -> Column:
    """First day of the month, as a date (the month period)."""
    return F.date_trunc("month", _col(c)).cast("date")


def days_before(as_of, days: int) -> Column:
    return F.date_sub(as_date(as_of), days)
