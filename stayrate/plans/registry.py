"""Registry of named queries: a Spark builder and, where SQL can state the
result, an independent DuckDB oracle over the same Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayrate.functions.numeric import round_half_up

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
SCALE = 6


def register(name: str, oracle: str | None = None):
    """Decorator: ``@register("name", sql)`` adds the query (and its oracle)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def finish(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """Round every double column half-up to ``scale`` decimals for comparison."""
    return df.select(*[round_half_up(c, scale).alias(c) if t in ("double", "float") else c
                       for c, t in df.dtypes])


def R(expr: str, scale: int = SCALE) -> str:
    """The same rounding, as SQL text for the oracle."""
    return f"floor(CAST({expr} AS DOUBLE) * 1e{scale} + 0.5) / 1e{scale}"
