"""Queries: sources / sinks round trips, sorting and the remaining variants."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.operators import eda
from stayrate.operators import features as fe
from stayrate.operators import profile as pr
from stayrate.operators import segments as sg
from stayrate.plans import q_profile, q_segments
from stayrate.plans.registry import ORACLES, R, finish, register
from stayrate.session import checkpoint_dir
from stayrate.sources.bucketed import bucket_tables
from stayrate.sources.fixtures import AS_OF, fixture, oracle_with
from stayrate.sources.sinks import read_versioned, write_versioned
from stayrate.sources.tables import SCHEMAS, load_csv_checked, load_tables

ROLES = q_profile.ROLES


def _shared(spark, name: str) -> str:
    """A new folder under the shared one: an earlier result keeps its files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stayrate-results/{name}-{uuid.uuid4().hex}"


@register("load_tables", ORACLES["table_shapes"])
def q_load_tables(spark, sf):
    """Write the six input tables as CSV, read them back with the declared
    schemas (dates parsed as yyyy-MM-dd) and report their shapes."""
    fx = fixture(spark, sf)
    base = _shared(spark, "csv")
    for role in ROLES:
        getattr(fx, role).write.option("header", True).csv(f"{base}/{role}.csv")
    return pr.table_shapes(load_tables(spark, base, fmt="csv", names=ROLES))


#: Tables of the given folder and the date columns read from them.
PARQUET = {"customer": [], "nation": [], "orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}


@register("load_tables_parquet", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS n_cols, "
    + (f"CAST(min({d[0]}) AS DATE) AS first_day, CAST(max({d[0]}) AS DATE) AS last_day" if d
       else "CAST(NULL AS DATE) AS first_day, CAST(NULL AS DATE) AS last_day") + f" FROM {t}" for t, d in PARQUET.items()))
def q_load_tables_parquet(spark, sf):
    """The Parquet tables as they lie, their dates as days: shapes and first and last day."""
    out = None
    for name, df in load_tables(spark, sf, "parquet", PARQUET, PARQUET).items():
        day = F.col(PARQUET[name][0]) if PARQUET[name] else F.lit(None).cast("date")
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "first_day", "last_day")
        out = one if out is None else out.unionByName(one)
    return out


@register("load_tables_bad_rows", oracle_with("f_customers") + f"""
SELECT 'good' AS part, count(*) AS n_rows, {R("sum(monthly_fee)", 4)} AS fees FROM f_customers WHERE customer_id % 10 NOT IN (3, 7)
UNION ALL SELECT 'bad', count(*), NULL FROM f_customers WHERE customer_id % 10 IN (3, 7)""")
def q_load_tables_bad_rows(spark, sf):
    """Customers as CSV, one line in five malformed (a word for the age, a field too many): rows that load
    and rows set aside."""
    base = _shared(spark, "csv-bad")
    c = fixture(spark, sf).customers
    kind = F.col("customer_id") % 10
    age = F.when(kind == 3, F.lit("unknown")).otherwise(F.col("age").cast("string"))
    fee = F.when(kind == 7, F.concat(F.col("monthly_fee").cast("string"), F.lit(",1"))).otherwise(F.col("monthly_fee").cast("string"))
    line = F.concat_ws(",", F.col("customer_id").cast("string"), F.col("signup_date").cast("string"), age, "gender", "country", "plan_type", fee)
    c.select(line.alias("value")).write.text(f"{base}/rows")
    schema = T.StructType([T.StructField(f.name, T.LongType()) if f.name == "customer_id" else f for f in SCHEMAS["customers"].fields])
    good, bad = load_csv_checked(spark, base, "customers", schema, header=False, location=f"{base}/rows")
    return finish(good.agg(F.lit("good").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("monthly_fee").alias("fees"))
                  .unionByName(bad.agg(F.lit("bad").alias("part"), F.count("table_name").alias("n_rows"), F.lit(None).cast("double").alias("fees"))), 4)


@register("write_results", ORACLES["segment_summary"])
def q_write_results(spark, sf):
    """Commit the segment summary as a version of its table and read that version back."""
    fx = fixture(spark, sf)
    summary = finish(sg.segment_summary(q_segments.assigned(spark, sf), fx.clv_labels, fx.churn_labels))
    path = f"{checkpoint_dir(spark).rstrip('/')}/stayrate-results/segment_summary"
    return read_versioned(spark, path, write_versioned(summary, path))


@register("customer_features_bucketed", ORACLES["customer_features"])
def q_customer_features_bucketed(spark, sf):
    """The feature table over tables bucketed by customer: no exchange below its joins."""
    fx = fixture(spark, sf)
    tables = {r: getattr(fx, r) for r in ("customers", "transactions", "events", "support_tickets")}
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = bucket_tables(spark, tables, _shared(spark, "buckets"), f"stayrate_{uuid.uuid4().hex[:12]}", buckets)
    return finish(fe.customer_features(t["customers"], t["transactions"], t["events"], t["support_tickets"], as_of=AS_OF))


@register("sort_by_customer_date", oracle_with("f_transactions") + f"""
SELECT customer_id, transaction_date, {R("amount")} AS amount, payment_method, is_refund
FROM f_transactions ORDER BY customer_id, transaction_date""")
def q_sort_by_customer_date(spark, sf):
    return finish(eda.sort_by_customer_date(fixture(spark, sf).transactions, "transaction_date"))


@register("histogram_clv_40", q_profile._hist_sql(("f_clv_labels",), "f_clv_labels", "clv", 40))
def q_histogram_clv_40(spark, sf):
    """The dashboard's 40-bin clv histogram."""
    return finish(pr.histogram(fixture(spark, sf).clv_labels, "clv", 40))
