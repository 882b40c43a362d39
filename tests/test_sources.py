"""Bucketed tables, versioned results, checked CSV loads and distributed dictionaries."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SMALL
from stayrate.functions import encoding as en
from stayrate.operators import features as fe
from stayrate.plans.registry import finish
from stayrate.sources import bucketed, sinks, tables
from stayrate.sources.fixtures import AS_OF, fixture


# -- bucketed tables ---------------------------------------------------------------------
def test_feature_plan_over_bucketed_tables_has_no_exchange(spark, tmp_path):
    fx = fixture(spark, SMALL)
    t = bucketed.bucket_tables(spark, {r: getattr(fx, r) for r in ("customers", "transactions", "events", "support_tickets")},
                               str(tmp_path), "t_bucketed", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = fe.customer_features(fx.customers, fx.transactions, fx.events, fx.support_tickets, as_of=AS_OF)
        df = fe.customer_features(t["customers"], t["transactions"], t["events"], t["support_tickets"], as_of=AS_OF)
        text = lambda d: d._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in text(plain)
        assert "Exchange" not in text(df) and text(df).count("SortMergeJoin") == 3
        rows = finish(df).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(str, rows)) == sorted(map(str, finish(plain).collect()))
    # another session opens them where they lie
    other = spark.newSession()
    other.sql("USE default")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t["events"].schema)
    again = bucketed.open_bucketed(other, "t_opened_events", f"{tmp_path}/events", schema, 8)
    assert again.count() == t["events"].count()
    for name in ("t_bucketed_customers", "t_bucketed_transactions", "t_bucketed_events", "t_bucketed_support_tickets", "t_opened_events"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# -- versioned results ----------------------------------------------------------------------
def test_two_runs_are_both_readable(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        sinks.read_versioned(spark, path)
    assert sinks.write_versioned(spark.range(3), path) == 1
    first = sinks.read_versioned(spark, path)
    assert sinks.write_versioned(spark.range(5), path) == 2
    assert (first.count(), sinks.read_versioned(spark, path).count(), sinks.read_versioned(spark, path, 1).count()) == (3, 5, 3)
    assert sinks.versions(spark, path) == [1, 2]
    with pytest.raises(FileNotFoundError):
        sinks.read_versioned(spark, path, 7)


def test_a_run_that_dies_is_never_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.write_versioned(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.write_versioned(spark.range(9).select(F.raise_error(F.lit("killed"))), path)
    monkeypatch.setattr(sinks, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sinks.write_versioned(spark.range(9), path)  # rows written, not committed
    monkeypatch.undo()
    assert sinks.versions(spark, path) == [1] and sinks.read_versioned(spark, path).count() == 3


def test_writers_that_meet_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.write_versioned(spark.range(1), path)
    monkeypatch.setattr(sinks, "versions", lambda *a: [])  # both saw nothing committed
    assert sinks.write_versioned(spark.range(2), path) == 2
    monkeypatch.undo()
    assert sinks.read_versioned(spark, path).count() == 2


# -- checked loads ---------------------------------------------------------------------------
def test_malformed_lines_are_set_aside(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(
        "customer_id,signup_date,age,gender,country,plan_type,monthly_fee\n"
        "C1,2024-01-31,30,Male,USA,Basic,9.99\n"
        "C2,2024-13-31,30,Male,USA,Basic,9.99\n"
        "C3,2024-01-31,old,Male,USA,Basic,9.99\n"
        "C4,2024-01-31,30,Male\n"
        "C5,2024-01-31,30,Male,USA,Basic,9.99,extra\n"
        "C6,2024-01-31,,,,,\n")
    good, bad = tables.load_csv_checked(spark, str(tmp_path), "customers")
    assert [r["customer_id"] for r in good.select("customer_id").orderBy("customer_id").collect()] == ["C1", "C6"]
    got = {r[tables.BAD_RECORD].split(",")[0]: r for r in bad.collect()}
    assert set(got) == {"C2", "C3", "C4", "C5"} and {r["table_name"] for r in got.values()} == {"customers"}
    assert got["C3"]["age"] is None and got["C3"]["monthly_fee"] == 9.99 and got["C3"][tables.BAD_RECORD].endswith("old,Male,USA,Basic,9.99")
    # what is selected later does not change what is bad
    assert good.select("customer_id").count() == 2 and good.select("gender").count() == 2


def test_parquet_tables_are_read_as_they_lie(spark):
    t = tables.load_tables(spark, SMALL, "parquet", ["orders"], {"orders": ["o_orderdate"]})["orders"]
    assert t.schema["o_orderdate"].dataType == T.DateType()
    text = spark._jvm.PythonSQLUtils.explainString(t.where("o_orderkey < 5").select("o_orderdate")._jdf.queryExecution(), "formatted")
    assert "LessThan(o_orderkey,5)" in text and "csv" not in text.lower()


# -- dictionaries ------------------------------------------------------------------------------
def test_a_million_levels_without_a_driver_list(spark, monkeypatch):
    n = 1_000_000
    df = spark.range(n).select(F.format_string("v%07d", (F.col("id") * 7919) % n).alias("v"))
    frame = type(df)
    collected = []
    plain = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (lambda rows: (collected.append(len(rows)), rows)[1])(plain(self)))
    coded = en.label_encode(df, "v", "code")
    r = coded.agg(F.count(F.lit(1)), F.countDistinct("code"), F.min("code"), F.max("code"),
                  F.sum((F.substring("v", 2, 7).cast("int") != F.col("code")).cast("int"))).first()
    assert tuple(r) == (n, n, 0, n - 1, 0)
    assert max(collected, default=0) <= 100


def test_codes_of_nulls_and_hot_levels(spark):
    rows = [("b",)] * 500 + [("a",), ("c",), (None,), ("ä",), ("",)]
    df = spark.createDataFrame(rows, "v string").repartition(6)
    got = {r["v"]: r["v_encoded"] for r in en.label_encode(df, "v").distinct().collect()}
    assert got == {"": 0, "a": 1, "b": 2, "c": 3, "ä": 4, None: 5}
    train = en.dictionary(df, "v")
    other = spark.createDataFrame([("b",), ("new",)], "v string")
    assert {r["v"]: r["v_encoded"] for r in en.label_encode(other, "v", codes=train).collect()} == {"b": 2, "new": 5}
    assert en.label_encode(df.limit(0), "v").count() == 0


def test_sparse_dummies(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("b",)], "v string")
    got = {r["v"]: r["v_vector"] for r in en.one_hot_vector(df, "v").collect()}
    assert {v: x.size for v, x in got.items()} == dict.fromkeys(["a", "b", "c", None], 4)
    assert {v: x.indices.tolist() for v, x in got.items()} == {"a": [0], "b": [1], "c": [2], None: [3]}


def test_many_levels_are_joined_not_listed(spark, monkeypatch):
    monkeypatch.setattr(en, "MAX_LEVELS", 30)  # countries: 25, plans: more
    fx = fixture(spark, SMALL)
    many = fx.customers.withColumn("plan_type", F.format_string("p%03d", F.col("customer_id") % 40))
    df = fe.customer_features(many, fx.transactions, fx.events, fx.support_tickets, as_of=AS_OF)
    assert all(r["plan_encoded"] == int(r["plan_type"][1:]) for r in df.select("plan_type", "plan_encoded").collect())
    with pytest.raises(ValueError):
        en.one_hot(many, "plan_type")
    # codes of the plain path are the same
    few = fe.customer_features(fx.customers, fx.transactions, fx.events, fx.support_tickets, as_of=AS_OF)
    codes = {(r["plan_type"], r["plan_encoded"]) for r in few.select("plan_type", "plan_encoded").distinct().collect()}
    assert sorted(c for _, c in sorted(codes)) == list(range(len(codes)))


def test_an_order_meets_its_customer_before_its_lines(spark):
    """The lines of all orders are joined, and shuffled, once; the rows are those of the view's text."""
    from stayrate.sources.fixtures import VIEW_SQL, fixture

    fx = fixture(spark, "/root/testdata/sf0.001")
    t = fx.transactions
    plan = t._jdf.queryExecution().optimizedPlan().toString()
    depth = {c: next(line.index("Relation") for line in plan.splitlines() if "Relation" in line and c in line)
             for c in ("l_orderkey", "o_orderkey", "c_custkey")}
    assert depth["l_orderkey"] < depth["o_orderkey"] <= depth["c_custkey"]
    plain = spark.sql(VIEW_SQL["f_transactions"], lineitem=fx.raw("lineitem"), orders=fx.raw("orders"), f_customers=fx.customers)
    assert t.dtypes == plain.dtypes and t.count() > 0
    assert t.exceptAll(plain).isEmpty() and plain.exceptAll(t).isEmpty()
