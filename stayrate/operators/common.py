"""Small shared helpers for operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalars(one_row: DataFrame, names: Sequence[str] | None = None) -> dict[str, Column]:
    """Fitted constants from a one-row aggregate, as literals.

    Like an ML estimator's ``fit``: one distributed aggregation, one bounded
    row to the driver, then the values enter later plans as constants (the
    plan does not re-run the aggregate once per use, as separate scalar
    subqueries would).
    """
    names = list(names or one_row.columns)
    row = one_row.select(*names).first()
    if row is None:
        return {n: F.lit(None) for n in names}
    return {n: F.lit(row[n]) for n in names}


def attach(df: DataFrame, one_row: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a one-row frame to every row of ``df``."""
    return df.withColumns(scalars(one_row, names))
