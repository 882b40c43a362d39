"""Right-closed banding, as ``pd.cut`` does it: ``(a, b]``; outside -> NULL.

``Bucketizer`` is left-closed, so the bands are a ``CASE WHEN`` chain that
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (the reference's bins and labels).
AGE_BINS = [17, 25, 35, 45, 55, 65, 100]
AGE_LABELS = ["18-25", "26-35", "36-45", "46-55", "56-65", "65+"]
FEE_BINS = [0, 10, 20, 40, 100]
FEE_LABELS = ["$0-10", "$10-20", "$20-40", "$40+"]
# Tenure bands named in the reference's findings: <=90, <=180, <=365, >365 days.
TENURE_BINS = [90, 180, 365]
TENURE_LABELS = ["0-90", "91-180", "181-365", "365+"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def right_closed_band(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the band ``(edges[i], edges[i+1]]`` holding ``c``; NULL outside."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    x = _col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def right_closed_ordinal(c, edges: Sequence[float]) -> Column:
    """0-based index of the right-closed band, NULL outside (keeps band order)."""
    x = _col(c)
    expr = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def age_band(c="age") -> Column:
    return right_closed_band(c, AGE_BINS, AGE_LABELS)


def fee_band(c="monthly_fee") -> Column:
    return right_closed_band(c, FEE_BINS, FEE_LABELS)


def open_ended_band(c, upper_edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``x <= e0 -> labels[0]``, ..., ``x > e_last -> labels[-1]`` (no NULL band)."""
    x = _col(c)
    expr = None
    for e, lab in zip(upper_edges, labels[:-1]):
        expr = F.when(x <= F.lit(e), F.lit(lab)) if expr is None else expr.when(x <= F.lit(e), F.lit(lab))
    return expr.when(x.isNotNull(), F.lit(labels[-1]))


def tenure_band(c="tenure_days") -> Column:
    return open_ended_band(c, TENURE_BINS, TENURE_LABELS)
