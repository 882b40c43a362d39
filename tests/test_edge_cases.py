"""Hand-made frames for the semantics the reference leaves implicit
(FIXTURES.md §3, S1-S14)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stayrate.functions.bands import age_band, fee_band
from stayrate.functions.encoding import label_encode
from stayrate.operators import features as fe
from stayrate.operators import metrics as me
from stayrate.operators import prep
from stayrate.operators import profile as pr
from stayrate.sources.tables import SCHEMAS

AS_OF = "2024-12-31"
D = dt.date


def tables(spark, customers, txns=(), events=(), tickets=()):
    return (spark.createDataFrame(list(customers), SCHEMAS["customers"]),
            spark.createDataFrame(list(txns), SCHEMAS["transactions"]),
            spark.createDataFrame(list(events), SCHEMAS["events"]),
            spark.createDataFrame(list(tickets), SCHEMAS["support_tickets"]))


def cust(cid, signup, plan="Basic", fee=9.99):
    return (cid, signup, 30, "Male", "USA", plan, fee)


def feats(spark, *args, **kw):
    c, t, e, k = tables(spark, *args)
    rows = fe.customer_features(c, t, e, k, as_of=AS_OF, **kw).collect()
    return {r["customer_id"]: r for r in rows}


def test_s1_events_per_day_uses_own_tenure(spark):
    cs = [cust("C1", D(2024, 12, 21)), cust("C2", D(2024, 12, 1)), cust("C3", D(2024, 11, 1))]
    ev = [("C2", D(2024, 12, 10), "login", 1.0), ("C2", D(2024, 12, 11), "login", 1.0),
          ("C3", D(2024, 12, 10), "login", 1.0)]
    f = feats(spark, cs, [], ev)
    assert f["C1"]["events_per_day"] == 0
    assert f["C2"]["events_per_day"] == pytest.approx(2 / 30)
    assert f["C3"]["events_per_day"] == pytest.approx(1 / 60)
    assert f["C2"]["active_days_ratio"] == pytest.approx(2 / 30)


def test_s2_customer_without_transactions(spark):
    cs = [cust("C1", D(2024, 1, 1))]
    zero = feats(spark, cs)
    assert zero["C1"]["recency_days"] == 0 and zero["C1"]["frequency"] == 0
    ten = feats(spark, cs, fill="tenure")
    assert ten["C1"]["recency_days"] == ten["C1"]["tenure_days"]
    assert ten["C1"]["has_txn"] is False and ten["C1"]["has_tickets"] is False


def test_s3_single_transaction_std_zero(spark):
    cs = [cust("C1", D(2024, 1, 1))]
    tx = [("C1", D(2024, 6, 1), 10.0, "PayPal", False)]
    f = feats(spark, cs, tx)
    assert f["C1"]["std_txn_amount"] == 0 and f["C1"]["monetary"] == 10.0


def test_s4_right_closed_bands(spark):
    ages = [17, 18, 25, 26, 65, 66, 100, 101]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(age_band("age")).collect()]
    assert got == [None, "18-25", "18-25", "26-35", "56-65", "65+", "65+", None]
    fees = spark.createDataFrame([(x,) for x in (9.99, 10.0, 19.99, 99.99)], "monthly_fee double")
    assert [r[0] for r in fees.select(fee_band("monthly_fee")).collect()] == \
        ["$0-10", "$0-10", "$10-20", "$40+"]


def test_s5_alphabetical_codes(spark):
    df = spark.createDataFrame([(p,) for p in ("Standard", "Basic", "Premium", "Enterprise")], "plan_type string")
    got = {r["plan_type"]: r["plan_encoded"] for r in label_encode(df, "plan_type", "plan_encoded").collect()}
    assert got == {"Basic": 0, "Enterprise": 1, "Premium": 2, "Standard": 3}


def test_s6_population_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    z = [(r.x, r.c) for r in prep.standardize(df, ["x", "c"]).orderBy("x").collect()]
    assert z[0][0] == pytest.approx(-1.2247449) and z[2][0] == pytest.approx(1.2247449)
    assert all(c == 0.0 for _, c in z)


def test_s7_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    rows = {(r.var1, r.var2): r.corr for r in pr.correlation_matrix(df, ["x", "c"]).collect()}
    assert rows[("x", "x")] == 1.0 and rows[("c", "x")] is None and rows[("c", "c")] is None


def test_s8_exact_quartiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    r = pr.describe(df, "v").first()
    assert r["q50"] == 2.5 and r["q25"] == 1.75 and r["q75"] == 3.25


def test_s9_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    counts = [r["count"] for r in pr.histogram(df, "v", 5).orderBy("bin").collect()]
    assert counts == [2, 2, 2, 2, 3]


def test_s10_recency_in_calendar_days(spark):
    cs = [cust("C1", D(2024, 1, 1)), cust("C2", D(2024, 1, 1))]
    tx = [("C1", D(2024, 12, 31), 5.0, "PayPal", False), ("C2", D(2024, 12, 30), 5.0, "PayPal", False)]
    f = feats(spark, cs, tx)
    assert f["C1"]["recency_days"] == 0 and f["C2"]["recency_days"] == 1


def test_s11_exact_stratified_split_any_partitioning(spark):
    rows = [(f"C{i:03d}", 1 if i < 13 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "customer_id string, churn_30d int")
    a = prep.stratified_split(df, "churn_30d", 0.2, 42)
    b = prep.stratified_split(df.repartition(7), "churn_30d", 0.2, 42)
    ta = {r.customer_id for r in a.where("split = 'test'").collect()}
    tb = {r.customer_id for r in b.where("split = 'test'").collect()}
    assert ta == tb and len(ta) == 20
    labels = {r.churn_30d for r in a.where("split = 'test'").collect()}
    assert labels == {0, 1}
    plain = prep.train_test_split(df.repartition(3), 0.2, 42)
    assert plain.where("split = 'test'").count() == 20


def test_s13_no_tickets_all_zero(spark):
    cs = [cust("C1", D(2024, 1, 1)), cust("C2", D(2024, 1, 1))]
    tk = [("T1", "C2", D(2024, 12, 1), "billing", 3.0, 4)]
    f = feats(spark, cs, [], [], tk)
    assert all(f["C1"][f"tickets_{c}"] == 0 for c in fe.TICKET_CATEGORIES)
    assert f["C2"]["tickets_billing"] == 1 and f["C2"]["recent_tickets"] == 1


def test_s14_rows_after_as_of_do_not_leak(spark):
    cs = [cust("C1", D(2024, 1, 1))]
    tx = [("C1", D(2024, 6, 1), 10.0, "PayPal", False)]
    ev = [("C1", D(2024, 6, 1), "login", 1.0)]
    tk = [("T1", "C1", D(2024, 6, 1), "billing", 3.0, 4)]
    base = feats(spark, cs, tx, ev, tk)["C1"].asDict()
    late = feats(spark, cs, tx + [("C1", D(2025, 1, 5), 99.0, "PayPal", False)],
                 ev + [("C1", D(2025, 1, 5), "purchase", 5.0)],
                 tk + [("T2", "C1", D(2025, 2, 1), "technical", 1.0, 1)])["C1"].asDict()
    assert base == late


def test_metrics_worked_example(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "label int, score double")
    assert me.roc_auc(df).first()["auc"] == pytest.approx(0.875)
    assert me.average_precision(df).first()["average_precision"] == pytest.approx(0.8333333)
    roc = [(r.fpr, r.tpr) for r in me.roc_curve(df).collect()]
    assert roc[0] == (0.0, 0.0) and (1.0, 1.0) in roc
