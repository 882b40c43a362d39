"""Queries: exact splits, scaling and class weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import prep
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import with_features
from stayrate.session import cut_lineage
from stayrate.sources.fixtures import fixture, oracle_with

SEG_COLS = ["tenure_days", "monthly_fee", "monetary", "total_events", "total_tickets",
            "avg_satisfaction", "recency_days", "frequency"]

SPLIT_SQL = """,
sh AS (SELECT customer_id, churn_30d, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM f_churn_labels),
sn AS (SELECT count(*) AS n, CAST(ceil(CAST(count(*) AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS nt FROM sh),
split AS (SELECT customer_id, churn_30d,
  CASE WHEN row_number() OVER (ORDER BY h) <= (SELECT nt FROM sn) THEN 'test' ELSE 'train' END AS split FROM sh)
"""

STRAT_SQL = """,
sh AS (SELECT customer_id, churn_30d, md5(CAST(customer_id AS VARCHAR) || ':42') AS h FROM f_churn_labels),
sn AS (SELECT count(*) AS n, CAST(ceil(CAST(count(*) AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS nt FROM sh),
cls AS (SELECT churn_30d, count(*) AS nc FROM sh GROUP BY 1),
al AS (SELECT churn_30d, CAST((SELECT nt FROM sn) AS DOUBLE) * nc / CAST((SELECT n FROM sn) AS DOUBLE) AS ex FROM cls),
al2 AS (SELECT churn_30d, floor(ex) AS base, ex - floor(ex) AS frac FROM al),
al3 AS (SELECT churn_30d, base + CASE WHEN row_number() OVER (ORDER BY frac DESC, churn_30d)
          <= (SELECT nt FROM sn) - (SELECT sum(base) FROM al2) THEN 1 ELSE 0 END AS ntc FROM al2),
split AS (SELECT s.customer_id, s.churn_30d,
  CASE WHEN row_number() OVER (PARTITION BY s.churn_30d ORDER BY s.h) <= a.ntc THEN 'test' ELSE 'train' END AS split
  FROM sh s JOIN al3 a ON s.churn_30d = a.churn_30d)
"""


def split_df(spark, sf):
    return prep.train_test_split(fixture(spark, sf).churn_labels, 0.2, 42)


def strat_df(spark, sf):
    return prep.stratified_split(fixture(spark, sf).churn_labels, "churn_30d", 0.2, 42)


@register("train_test_split", oracle_with("f_churn_labels") + SPLIT_SQL +
          "SELECT customer_id, split FROM split")
def q_train_test_split(spark, sf):
    return split_df(spark, sf).select("customer_id", "split")


@register("stratified_split", oracle_with("f_churn_labels") + STRAT_SQL +
          "SELECT customer_id, churn_30d, split FROM split")
def q_stratified_split(spark, sf):
    return strat_df(spark, sf).select("customer_id", "churn_30d", "split")


@register("split_rates", oracle_with("f_churn_labels") + STRAT_SQL + f"""
SELECT split, count(*) AS n_rows, {R("avg(CAST(churn_30d AS DOUBLE))")} AS label_rate FROM split GROUP BY 1""")
def q_split_rates(spark, sf):
    return finish(prep.split_rates(strat_df(spark, sf), "churn_30d"))


@register("standardize", with_features("f_churn_labels") + SPLIT_SQL + f""",
tr AS (SELECT f.* FROM feat f JOIN split s ON f.customer_id = s.customer_id WHERE s.split = 'train'),
st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}"
                         for c in SEG_COLS)} FROM tr)
SELECT f.customer_id, {", ".join(
    R(f"CASE WHEN s_{c} > 0 THEN (CAST(f.{c} AS DOUBLE) - m_{c}) / s_{c} ELSE 0.0 END") + f" AS {c}"
    for c in SEG_COLS)}
FROM feat f, st""")
def q_standardize(spark, sf):
    """Population-std scaling fitted on the training part only, applied to all."""
    f = features_df(spark, sf).select("customer_id", *SEG_COLS)
    df = cut_lineage(prep.train_test_split(f, 0.2, 42))  # the fit and the result read it
    z = prep.standardize(df, SEG_COLS, F.col("split") == "train")
    return finish(z.select("customer_id", *SEG_COLS))


@register("class_weights", oracle_with("f_churn_labels") + f"""
SELECT churn_30d, count(*) AS n_c,
  {R("CAST((SELECT count(*) FROM f_churn_labels) AS DOUBLE) / (2 * count(*))")} AS weight
FROM f_churn_labels GROUP BY 1""")
def q_class_weights(spark, sf):
    return finish(prep.class_weights(fixture(spark, sf).churn_labels, "churn_30d"))


@register("scale_pos_weight", oracle_with("f_churn_labels") + STRAT_SQL + f"""
SELECT {R("CAST(count(*) FILTER (WHERE churn_30d <> 1) AS DOUBLE) / count(*) FILTER (WHERE churn_30d = 1)")}
  AS scale_pos_weight FROM split WHERE split = 'train'""")
def q_scale_pos_weight(spark, sf):
    train = strat_df(spark, sf).where(F.col("split") == "train")
    return finish(prep.scale_pos_weight(train, "churn_30d"))


_Z = [f"CASE WHEN s_{c} > 0 THEN (CAST(f.{c} AS DOUBLE) - m_{c}) / s_{c} ELSE 0.0 END" for c in SEG_COLS]
_HEX = "CAST('0x' || substr(md5(CAST(b.customer_id AS VARCHAR) || ':' || CAST(b.copy AS VARCHAR) || ':{}42'), 1, 8) AS BIGINT)"


@register("smote", with_features("f_churn_labels") + STRAT_SQL + f""",
tr AS (SELECT f.*, s.churn_30d FROM feat f JOIN split s ON f.customer_id = s.customer_id WHERE s.split = 'train'),
st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in SEG_COLS)} FROM tr),
z AS (SELECT customer_id, churn_30d, {", ".join(f"{e} AS {c}" for e, c in zip(_Z, SEG_COLS))} FROM tr f, st),
cn AS (SELECT churn_30d, count(*) AS n, max(count(*)) OVER () - count(*) AS wanted FROM z GROUP BY 1),
mn AS (SELECT z.*, cn.n, cn.wanted, row_number() OVER (PARTITION BY churn_30d
         ORDER BY md5(CAST(customer_id AS VARCHAR) || ':42')) AS place
       FROM z JOIN cn USING (churn_30d) WHERE wanted > 0),
b AS (SELECT mn.*, unnest(generate_series(1, CAST(wanted // n + CASE WHEN place <= wanted % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM mn),
near AS (SELECT x.customer_id, y.customer_id AS other, row_number() OVER (PARTITION BY x.customer_id
           ORDER BY sqrt({" + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in SEG_COLS)}), y.customer_id) AS rank
         FROM mn x JOIN mn y ON x.churn_30d = y.churn_30d AND x.customer_id <> y.customer_id QUALIFY rank <= 5)
SELECT b.customer_id AS base, b.copy, t.customer_id AS neighbour, {R(_HEX.format("u") + " / 4294967296.0")} AS u, b.churn_30d,
  {", ".join(R(f"b.{c} + {_HEX.format('u')} / 4294967296.0 * (t.{c} - b.{c})") + f" AS {c}" for c in SEG_COLS)}
FROM b JOIN near r ON r.customer_id = b.customer_id AND r.rank = 1 + {_HEX.format("n")} % 5
JOIN mn t ON t.customer_id = r.other""")
def q_smote(spark, sf):
    """Synthetic churners between near neighbours of the scaled training part, up to equal classes."""
    return finish(prep.smote(scaled_train(spark, sf), "churn_30d", SEG_COLS))


def scaled_train(spark, sf):
    """The stratified training part with the segmentation columns, scaled on it."""
    f = features_df(spark, sf).select("customer_id", *SEG_COLS)
    df = cut_lineage(f.join(strat_df(spark, sf), "customer_id").where(F.col("split") == "train").drop("split"))
    return prep.standardize(df, SEG_COLS)
