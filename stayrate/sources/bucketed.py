"""Tables bucketed and sorted by customer, so that per-customer joins and aggregates need no exchange.

The activity tables are written once in ``buckets`` files by the hash of the key;
every later feature run groups and joins them bucket by bucket where they lie.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

KEY = "customer_id"


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str = KEY) -> None:
    """Write ``df`` as the table ``name`` under ``path``; one task writes each bucket."""
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("overwrite").saveAsTable(name))


def open_bucketed(spark: SparkSession, name: str, path: str, schema: str, buckets: int, key: str = KEY) -> DataFrame:
    """A table that another session wrote, under its name in this session's catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({schema}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def bucket_tables(spark: SparkSession, tables: Mapping[str, DataFrame], path: str, prefix: str, buckets: int,
                  key: str = KEY) -> dict[str, DataFrame]:
    """All tables bucketed alike under ``path``, by role."""
    out = {}
    for role, df in tables.items():
        save_bucketed(df, f"{prefix}_{role}", f"{path.rstrip('/')}/{role}", buckets, key)
        out[role] = spark.table(f"{prefix}_{role}")
    return out
