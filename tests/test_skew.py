"""A hot key holding a third of all rows must not change results."""

import datetime as dt
import statistics

import numpy as np
import pytest

from stayrate.operators import features as fe
from stayrate.sources.tables import SCHEMAS


def test_hot_customer_transaction_features(spark):
    rng = np.random.default_rng(11)
    n = 9000
    cust = [f"C{int(i):04d}" for i in rng.integers(1, 500, n)]
    cust[: n // 3] = ["HOT"] * (n // 3)
    rows = []
    for i, c in enumerate(cust):
        refund = bool(rng.random() < 0.2)
        amt = round(float(rng.uniform(1, 500)), 2)
        rows.append((c, dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 360))),
                     -amt if refund else amt, ["A", "B", "C"][i % 3], refund))
    df = spark.createDataFrame(rows, SCHEMAS["transactions"]).repartition(8)
    got = {r.customer_id: r for r in fe.txn_features(df, "2024-12-31").collect()}
    hot = [r for r in rows if r[0] == "HOT"]
    pos = [r[2] for r in hot if not r[4]]
    g = got["HOT"]
    assert g.frequency == len(pos)
    assert g.monetary == pytest.approx(sum(pos), abs=1e-6)
    assert g.max_txn_amount == max(pos)
    assert g.std_txn_amount == pytest.approx(statistics.stdev(pos))
    assert g.refund_count == len(hot) - len(pos)
    assert g.payment_method_count == 3
    assert g.recency_days == (dt.date(2024, 12, 31) - max(r[1] for r in hot if not r[4])).days
    assert len(got) == len({r[0] for r in rows})


def test_split_with_a_hot_key_keeps_rows_together(spark):
    from stayrate.operators import prep
    rows = [("HOT", i) for i in range(300)] + [(f"K{i:04d}", i) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_id string, v int").repartition(6)
    out = prep.train_test_split(df, 0.2, 42).collect()
    hot_sides = {r.split for r in out if r.customer_id == "HOT"}
    assert len(hot_sides) == 1                       # the key is never split
    n_test = sum(1 for r in out if r.split == "test")
    assert n_test >= 180                             # ceil(0.2 * 900), whole keys
    uniq = spark.createDataFrame([(f"K{i:04d}",) for i in range(901)], "customer_id string")
    assert prep.train_test_split(uniq, 0.2, 42).where("split = 'test'").count() == 181
