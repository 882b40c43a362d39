"""stayrate: customer-value and retention analytics as lazy Spark DataFrame operators.

Layout:
  sources/    table schemas, readers, sinks and the views over the driver tables
  functions/  column expressions (bands, dates, safe arithmetic, encoders)
  operators/  DataFrame -> DataFrame operators (features, EDA, profiles, splits,
              models, metrics, segments, risk lists)
  plans/      the registered queries and their DuckDB oracle SQL
  streaming/  incremental daily scoring over arriving activity files
"""

from stayrate.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
