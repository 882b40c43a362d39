"""Queries: evaluation operators over a fixed score column (``f_scores``) so
that evaluation is checked apart from any model."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import metrics as me
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import with_features
from stayrate.sources.fixtures import fixture, oracle_with

S = oracle_with("f_scores")
SC = S + """,
sc AS (SELECT CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
          count(*) FILTER (WHERE label <> 1) AS neg FROM f_scores GROUP BY 1),
cd AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
          sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM sc),
tt AS (SELECT sum(pos) AS p, sum(neg) AS n FROM sc)
"""
CNT = """(SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
  count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM f_scores)"""


def scores(spark, sf):
    return fixture(spark, sf).scores


@register("roc_auc", SC + f"""
SELECT {R("CAST(sum(pos * (n_below + neg * 0.5)) AS DOUBLE) / (CAST((SELECT p FROM tt) AS DOUBLE) * (SELECT n FROM tt))")} AS auc
FROM (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS n_below FROM sc)""")
def q_roc_auc(spark, sf):
    return finish(me.roc_auc(scores(spark, sf)))


@register("roc_curve", SC + f"""
SELECT {R("score")} AS threshold, {R("cum_neg / (SELECT n FROM tt)")} AS fpr, {R("cum_pos / (SELECT p FROM tt)")} AS tpr
FROM cd UNION ALL SELECT NULL, 0.0, 0.0""")
def q_roc_curve(spark, sf):
    return finish(me.roc_curve(scores(spark, sf)))


@register("pr_curve", SC + f"""
SELECT {R("score")} AS threshold, {R("cum_pos / (cum_pos + cum_neg)")} AS precision,
  {R("cum_pos / (SELECT p FROM tt)")} AS recall FROM cd
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_curve(spark, sf):
    return finish(me.pr_curve(scores(spark, sf)))


@register("average_precision", SC + f"""
SELECT {R("sum(pos * cum_pos / (cum_pos + cum_neg)) / (SELECT p FROM tt)")} AS average_precision FROM cd""")
def q_average_precision(spark, sf):
    return finish(me.average_precision(scores(spark, sf)))


@register("precision_recall_f1", S + f"""
SELECT {R("tp / (tp + fp)")} AS precision, {R("tp / (tp + fn)")} AS recall,
  {R("2.0 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn)))")} AS f1
FROM {CNT}""")
def q_precision_recall_f1(spark, sf):
    return finish(me.precision_recall_f1(scores(spark, sf)))


@register("confusion_matrix", S + """
SELECT a AS actual, p AS predicted,
  (SELECT count(*) FROM f_scores WHERE label = a AND prediction = p) AS count
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(a, p)""")
def q_confusion_matrix(spark, sf):
    return me.confusion_matrix(scores(spark, sf))


@register("sensitivity_specificity", S + f"""
SELECT tn, fp, fn, tp, {R("tp / (tp + fn)")} AS sensitivity, {R("tn / (tn + fp)")} AS specificity
FROM {CNT}""")
def q_sensitivity_specificity(spark, sf):
    return finish(me.sensitivity_specificity(scores(spark, sf)))


_P1, _R1 = "(tp / (tp + fp))", "(tp / (tp + fn))"
_P0, _R0 = "(tn / (tn + fn))", "(tn / (tn + fp))"
_F1 = f"(2.0 * {_P1} * {_R1} / ({_P1} + {_R1}))"
_F0 = f"(2.0 * {_P0} * {_R0} / ({_P0} + {_R0}))"


@register("classification_report", S + f"""
SELECT 'Retained' AS class_name, {R(_P0)} AS precision, {R(_R0)} AS recall, {R(_F0)} AS f1_score,
  tn + fp AS support FROM {CNT}
UNION ALL SELECT 'Churned', {R(_P1)}, {R(_R1)}, {R(_F1)}, tp + fn FROM {CNT}
UNION ALL SELECT 'accuracy', NULL, NULL, {R("(tp + tn) / (tp + tn + fp + fn)")}, tp + tn + fp + fn FROM {CNT}
UNION ALL SELECT 'macro avg', {R(f"({_P0} + {_P1}) / 2")}, {R(f"({_R0} + {_R1}) / 2")},
  {R(f"({_F0} + {_F1}) / 2")}, tp + tn + fp + fn FROM {CNT}
UNION ALL SELECT 'weighted avg', {R(f"({_P0} * (tn + fp) + {_P1} * (tp + fn)) / (tp + tn + fp + fn)")},
  {R(f"({_R0} * (tn + fp) + {_R1} * (tp + fn)) / (tp + tn + fp + fn)")},
  {R(f"({_F0} * (tn + fp) + {_F1} * (tp + fn)) / (tp + tn + fp + fn)")}, tp + tn + fp + fn FROM {CNT}""")
def q_classification_report(spark, sf):
    return finish(me.classification_report(scores(spark, sf)))


def baseline_predictions(spark, sf):
    """Actual clv against a fixed naive prediction (non-refund spend / 100)."""
    f = features_df(spark, sf).select("customer_id", (F.col("monetary") / F.lit(100.0)).alias("predicted"))
    return fixture(spark, sf).clv_labels.select("customer_id", F.col("clv").alias("actual")) \
        .join(f, "customer_id")


BASE = with_features("f_clv_labels") + """,
bp AS (SELECT l.customer_id, l.clv AS actual, f.monetary / 100.0 AS predicted
       FROM f_clv_labels l JOIN feat f ON l.customer_id = f.customer_id)
"""


@register("regression_metrics", BASE + f"""
SELECT count(*) AS n, {R("sqrt(sum((actual - predicted) * (actual - predicted)) / count(*))")} AS rmse,
  {R("sum(abs(actual - predicted)) / count(*)")} AS mae,
  {R("1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))")} AS r2
FROM bp""")
def q_regression_metrics(spark, sf):
    return finish(me.regression_metrics(baseline_predictions(spark, sf)))


@register("residuals", BASE + f"""
SELECT customer_id, {R("actual")} AS actual, {R("predicted")} AS predicted,
  {R("actual - predicted")} AS residual, {R("(SELECT min(actual) FROM bp)")} AS axis_min,
  {R("(SELECT max(actual) FROM bp)")} AS axis_max FROM bp""")
def q_residuals(spark, sf):
    return finish(me.residuals(baseline_predictions(spark, sf)))
