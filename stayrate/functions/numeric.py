"""Arithmetic that is safe under ANSI mode and exact where money is summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """``a / b``, NULL when ``b`` is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(_col(a), _col(b))


def clip_lower(c, lower=1) -> Column:
    return F.greatest(_col(c), F.lit(lower))


def log_target(c) -> Column:
    return F.log1p(_col(c))


def inverse_log_target(c) -> Column:
    return F.expm1(_col(c))


def money_sum(c) -> Column:
    """Exact sum of a money column (decimal), returned as double.

    Decimal addition is associative, so the result does not depend on how
    rows are partitioned or in which order partial sums merge."""
    return F.sum(_col(c).cast(MONEY)).cast("double")


def money_avg(c) -> Column:
    """Mean of a money column from the exact sum (NULL for no rows)."""
    return safe_div(money_sum(c), F.count(_col(c)))


def rate_percent(c) -> Column:
    """Mean of a 0/1 column times 100."""
    return F.avg(_col(c).cast("double")) * F.lit(100.0)


def round_half_up(c, scale: int = 6) -> Column:
    """``floor(x * 10^s + 0.5) / 10^s`` in double arithmetic (display / compare)."""
    f = float(10 ** scale)
    return F.floor(_col(c) * F.lit(f) + F.lit(0.5)) / F.lit(f)
