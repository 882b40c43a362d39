"""The six input tables: declared schemas, readers and date parsing.

Inputs are keyed by ``customer_id``.  Dates are always ``DateType``: string
dates are parsed with an explicit format and zone-less Parquet timestamps
(which Spark reads as ``timestamp_ntz``) are cast to date.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.session import cut_lineage

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("plan_type", T.StringType()),
    T.StructField("monthly_fee", T.DoubleType()),
])
TRANSACTIONS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("is_refund", T.BooleanType()),
])
EVENTS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_value", T.DoubleType()),
])
SUPPORT_TICKETS = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("ticket_date", T.DateType()),
    T.StructField("ticket_category", T.StringType()),
    T.StructField("resolution_time_hrs", T.DoubleType()),
    T.StructField("satisfaction_score", T.IntegerType()),
])
CHURN_LABELS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("churn_30d", T.IntegerType()),
])
CLV_LABELS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("clv", T.DoubleType()),
])

SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
    "events": EVENTS,
    "support_tickets": SUPPORT_TICKETS,
    "churn_labels": CHURN_LABELS,
    "clv_labels": CLV_LABELS,
}

DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": ("signup_date",),
    "transactions": ("transaction_date",),
    "events": ("event_date",),
    "support_tickets": ("ticket_date",),
}


def parse_dates(df: DataFrame, cols: Iterable[str], fmt: str | None = None) -> DataFrame:
    """Turn string / timestamp / timestamp_ntz columns into ``DateType``.

    Strings use ``to_date`` (with ``fmt`` when given); timestamps are cast,
    which keeps the calendar day (no time zone shift for ``timestamp_ntz``).
    """
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        t = types[c]
        if t == "date":
            continue
        if t == "string":
            out[c] = F.to_date(F.col(c), fmt) if fmt else F.to_date(F.col(c))
        else:
            out[c] = F.col(c).cast("date")
    return df.withColumns(out) if out else df


def load_tables(spark: SparkSession, path: str, fmt: str = "parquet", names: Iterable[str] | None = None,
                dates: Mapping[str, Sequence[str]] = DATE_COLUMNS) -> dict[str, DataFrame]:
    """Read tables from ``path/<name>.<fmt>`` (files or folders), the six by default.

    CSV is read with the declared schema (no inference pass) and dates in
    ``yyyy-MM-dd``; fields that do not fit become NULL (see ``load_csv_checked``).
    Parquet keeps the file schema, whatever the table, and its ``dates`` columns are
    normalised with ``parse_dates``, so column pruning and filter pushdown still reach
    the scan.
    """
    out = {}
    for name in names or SCHEMAS:
        location = f"{path.rstrip('/')}/{name}.{fmt}"
        if fmt == "csv":
            df = (spark.read.schema(SCHEMAS[name]).option("header", True)
                  .option("dateFormat", "yyyy-MM-dd").csv(location))
        else:
            df = spark.read.format(fmt).load(location)
            df = parse_dates(df, dates.get(name, ()))
        out[name] = df
    return out


#: The column of a malformed line's text.
BAD_RECORD = "_bad_record"


def load_csv_checked(spark: SparkSession, path: str, name: str, schema: T.StructType | None = None, header: bool = True,
                     location: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``path/<name>.csv`` (or ``location``) that fit the declared schema, and those that do not.

    A line with too few or too many fields, or with a field that is not of its type, goes to the
    second frame: (table_name, the fields that could be read, ``_bad_record``: the line).
    Lines are parsed permissively, whole (a pruned column would not be judged) and once: the
    parsed rows are stored in the checkpoint folder.  Nothing is lost and nothing stops the load.
    """
    schema = schema or SCHEMAS[name]
    with_bad = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    rows = (spark.read.schema(with_bad).option("header", header).option("dateFormat", "yyyy-MM-dd").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_RECORD).csv(location or f"{path.rstrip('/')}/{name}.csv"))
    rows = cut_lineage(rows)
    good = rows.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    bad = rows.where(F.col(BAD_RECORD).isNotNull()).select(F.lit(name).alias("table_name"), "*")
    return good, bad


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
