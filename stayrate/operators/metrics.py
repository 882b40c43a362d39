"""Model evaluation as plain aggregates over ``(label, score, prediction)``.

Everything is exact (no score binning): ROC AUC averages ties, average
precision is the step-wise sum (not a trapezoid).  Curves need running totals
over the distinct scores; ``running_totals`` computes them without moving all
scores into one task: scores are grouped first, cut into equal-count buckets,
prefix totals of the (at most ``buckets``) bucket sums come from a small
window, and each bucket computes its own running sums in parallel.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.numeric import safe_div
from stayrate.operators.common import scalars

LABEL, SCORE, PRED = "label", "score", "prediction"
ROWS_PER_BUCKET = 100_000
# Bucket totals are broadcast while they are at most so many rows.
BROADCAST_BUCKETS = 4096


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                   buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows whose ``order_col`` comes at or
    before this row's (``order_col`` must be unique, e.g. grouped scores).

    Rows are cut into equal-count buckets by ``QuantileDiscretizer`` (an
    approximate-quantile fit, then a binary-search ``Bucketizer``), about
    ``ROWS_PER_BUCKET`` rows each whatever the score distribution (``buckets``
    sets their number; up to ``ROWS_PER_BUCKET`` rows need no cut).  Bucket
    offsets come from a window over the bucket totals; each bucket runs its own
    running sum in parallel."""
    src = df.where(F.col(order_col).isNotNull())
    n = src.count()
    k = max(1, math.ceil(n / ROWS_PER_BUCKET))
    k = k if buckets is None else min(buckets, k)
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    if k == 1:
        # at most ROWS_PER_BUCKET rows: one ordered running sum, no offsets
        w1 = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return src.withColumns({f"cum_{c}": F.sum(c).over(w1) for c in sum_cols})
    else:
        src = src.withColumn("_x", F.col(order_col).cast("double"))
        qd = QuantileDiscretizer(numBuckets=k, inputCol="_x", outputCol="_b",
                                 relativeError=1.0 / (4 * k), handleInvalid="keep")
        d = qd.fit(src).transform(src)
        b = F.col("_b").cast("int")
        if descending:
            b = F.lit(k) - b
        d = d.withColumn("_bucket", b).drop("_b", "_x")
    tot = d.groupBy("_bucket").agg(*[F.sum(c).alias(f"_bt_{c}") for c in sum_cols])
    # One row per bucket: a small ordered window gives the bucket offsets.
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = tot.select("_bucket", *[(F.sum(f"_bt_{c}").over(wb) - F.col(f"_bt_{c}")).alias(f"_off_{c}")
                                  for c in sum_cols])
    wi = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                                  Window.currentRow)
    d = d.join(F.broadcast(tot) if k <= BROADCAST_BUCKETS else tot, "_bucket")
    return d.withColumns({f"cum_{c}": F.col(f"_off_{c}") + F.sum(c).over(wi) for c in sum_cols}) \
        .drop("_bucket", *[f"_off_{c}" for c in sum_cols])


def score_counts(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Positives and negatives per distinct score (partial aggregation map-side)."""
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_auc(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Area under the ROC curve with ties counted one half (Mann-Whitney)."""
    sc = running_totals(score_counts(df, label, score), "score", ["neg"])
    # negatives strictly below this score = cum_neg - neg
    agg = sc.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * F.lit(0.5)))
                 .alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return agg.select(safe_div(F.col("u"), F.col("p") * F.col("n")).alias("auc"))


def roc_curve(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """One point per distinct score, highest first, plus the (0, 0) start
    (threshold NULL = above every score)."""
    sc = running_totals(score_counts(df, label, score), "score", ["pos", "neg"], descending=True)
    tot = scalars(sc.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")))
    p, n = tot["p"], tot["n"]
    pts = sc.select(F.col("score").alias("threshold"), safe_div(F.col("cum_neg"), n).alias("fpr"),
                    safe_div(F.col("cum_pos"), p).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                             F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(pts)


def pr_curve(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Precision and recall at each distinct score threshold (score >= t), and
    the final (recall 0, precision 1) point with threshold NULL."""
    sc = running_totals(score_counts(df, label, score), "score", ["pos", "neg"], descending=True)
    p = sc.select(F.sum("pos")).scalar()
    pts = sc.select(F.col("score").alias("threshold"),
                    F.coalesce(safe_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")),
                               F.lit(0.0)).alias("precision"),
                    F.coalesce(safe_div(F.col("cum_pos"), p), F.lit(1.0)).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                           F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """sum_k (R_k - R_{k-1}) P_k over thresholds from the highest score down."""
    sc = running_totals(score_counts(df, label, score), "score", ["pos", "neg"], descending=True)
    agg = sc.agg(F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("s"),
                 F.sum("pos").alias("p"))
    return agg.select(safe_div(F.col("s"), F.col("p")).alias("average_precision"))


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, yh = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (yh == 1)).alias("tp"), F.count_if((y != 1) & (yh == 1)).alias("fp"),
                  F.count_if((y == 1) & (yh != 1)).alias("fn"), F.count_if((y != 1) & (yh != 1)).alias("tn"))


def _prf(tp, fp, fn):
    prec = F.coalesce(safe_div(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(safe_div(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(safe_div(F.lit(2.0) * prec * rec, prec + rec), F.lit(0.0))
    return prec, rec, f1


def precision_recall_f1(df: DataFrame, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """Positive-class precision, recall and F1 (0 where undefined)."""
    c = _counts(df, label, pred)
    prec, rec, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def confusion_matrix(df: DataFrame, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """All four cells (actual, predicted, count), empty cells included."""
    counts = df.groupBy(F.col(label).cast("int").alias("actual"),
                        F.col(pred).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    cells = df.sparkSession.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)],
                                            "actual int, predicted int")
    return F.broadcast(cells).join(counts, ["actual", "predicted"], "left") \
        .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


def sensitivity_specificity(df: DataFrame, label: str = LABEL, pred: str = PRED) -> DataFrame:
    c = _counts(df, label, pred)
    return c.select("tn", "fp", "fn", "tp",
                    safe_div(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"),
                    safe_div(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"))


def classification_report(df: DataFrame, label: str = LABEL, pred: str = PRED,
                          names: Sequence[str] = ("Retained", "Churned")) -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and
    weighted averages (one aggregate, then a fixed 5-row unpivot)."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1_1 = _prf(tp, fp, fn)          # class 1
    p0, r0, f1_0 = _prf(tn, fn, fp)          # class 0: roles of the cells swap
    s1, s0 = (tp + fn), (tn + fp)
    tot = s0 + s1
    acc = safe_div(tp + tn, tot)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("bigint").alias("support"))

    rows = [row(names[0], p0, r0, f1_0, s0), row(names[1], p1, r1, f1_1, s1),
            row("accuracy", F.lit(None), F.lit(None), acc, tot),
            row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, tot),
            row("weighted avg", safe_div(p0 * s0 + p1 * s1, tot), safe_div(r0 * s0 + r1 * s1, tot),
                safe_div(f1_0 * s0 + f1_1 * s1, tot), tot)]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """RMSE, MAE and R² (1 - SSE / SST around the mean of the actuals)."""
    e = F.col(actual) - F.col(predicted)
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.sum(e * e).alias("sse"), F.sum(F.abs(e)).alias("sae"),
                 F.var_pop(actual).alias("var"))
    return agg.select("n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
                      (F.col("sae") / F.col("n")).alias("mae"),
                      (F.lit(1.0) - safe_div(F.col("sse"), F.col("var") * F.col("n"))).alias("r2"))


def residuals(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
              key: str = "customer_id") -> DataFrame:
    """Actual, predicted and residual per row, with the actuals' range for the
    diagonal reference line."""
    rng = scalars(df.agg(F.min(actual).alias("lo"), F.max(actual).alias("hi")))
    lo, hi = rng["lo"], rng["hi"]
    return df.select(key, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"),
                     (F.col(actual) - F.col(predicted)).alias("residual"),
                     lo.alias("axis_min"), hi.alias("axis_max"))
