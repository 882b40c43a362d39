"""Customer segmentation: K-Means with restarts, elbow, assignment, PCA.

Centroids are small (k x 8 numbers), so assignment to the nearest centroid is
pure column arithmetic with the centroids as constants: no join and no Python
code per row.  Segment ids are relabelled by mean clv
(descending), so segment 0 is always the most valuable one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions.numeric import money_avg
from stayrate.operators import prep
from stayrate.operators.gram import gram
from stayrate.operators.kmeans import KMeansRun, fit_many
from stayrate.operators.quantiles import quantile_row
from stayrate.session import cut_lineage

# The reference's segmentation inputs.
SEG_FEATURES = ["tenure_days", "monthly_fee", "monetary", "total_events", "total_tickets",
                "avg_satisfaction", "recency_days", "frequency"]
MONEY_COLS = {"monthly_fee", "monetary"}


def segment_features(features: DataFrame, cols: Sequence[str] = SEG_FEATURES,
                     key: str = "customer_id") -> DataFrame:
    """The segmentation columns, nulls -> 0, standardized (population std)."""
    df = features.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).fillna(0.0)
    # The scaler fit, centroid choice and K-Means restarts all read this
    # narrow frame: compute the feature pipeline once.
    df = cut_lineage(df)
    return prep.standardize(df, cols)


def _vectors(df: DataFrame, cols: Sequence[str], *keep: str) -> DataFrame:
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))


def kmeans_best(vec: DataFrame, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> KMeansRun | None:
    """The run of least inertia of ``n_init`` (ties: the lowest seed); all runs share their passes."""
    runs = fit_many(vec, [(k, seed + i) for i in range(n_init)], max_iter, tol)
    return min(runs, key=lambda r: (r.inertia, r.seed), default=None)


def elbow(scaled: DataFrame, ks: Sequence[int] = range(2, 11), n_init: int = 10, seed: int = 42,
          cols: Sequence[str] = SEG_FEATURES) -> DataFrame:
    """Inertia (sum of squared distances) of the best run for each k; all (k, restart) models
    are updated by the same pass per iteration."""
    vec = cut_lineage(_vectors(scaled, cols)).persist()
    runs = fit_many(vec, [(int(k), seed + i) for k in ks for i in range(n_init)])
    vec.unpersist()
    best: dict[int, float] = {}
    for r in runs:
        best[r.k] = min(best.get(r.k, float("inf")), r.inertia)
    return scaled.sparkSession.createDataFrame([(k, best[k]) for k in sorted(best)], "k int, inertia double")


def assign_segment(scaled: DataFrame, centroids: Sequence[Sequence[float]],
                   cols: Sequence[str] = SEG_FEATURES, out: str = "segment") -> DataFrame:
    """Index of the nearest centroid (squared Euclidean; ties -> lowest index).

    The k distances are computed once into an array column; the segment is
    the position of its minimum."""
    dists = []
    for c in centroids:
        d = None
        for col, v in zip(cols, c):
            t = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = t if d is None else d + t
        dists.append(d)
    with_d = scaled.withColumn("_dist", F.array(*dists))
    seg = (F.array_position(F.col("_dist"), F.array_min(F.col("_dist"))) - 1).cast("int")
    return with_d.withColumn(out, seg).drop("_dist")


def relabel_by_value(seg: DataFrame, clv: DataFrame, raw: str = "cluster", out: str = "segment",
                     key: str = "customer_id") -> DataFrame:
    """Renumber clusters by mean clv, highest first (k rows reach the driver)."""
    means = seg.join(clv, key, "left").groupBy(raw).agg(F.avg("clv").alias("m")) \
               .orderBy(F.desc_nulls_last("m"), F.asc(raw)).collect()
    mapping = F.create_map(*[x for i, r in enumerate(means) for x in (F.lit(r[raw]), F.lit(i))])
    return seg.withColumn(out, mapping[F.col(raw)]).drop(raw)


def kmeans_segments(features: DataFrame, clv: DataFrame, k: int = 4, n_init: int = 10, seed: int = 42,
                    key: str = "customer_id"):
    """Best-of-``n_init`` K-Means on the scaled segment features; returns
    ``(key, segment)`` (relabelled) and the best run."""
    scaled = cut_lineage(segment_features(features, key=key)).persist()
    run = kmeans_best(_vectors(scaled, SEG_FEATURES), k, n_init, seed)
    centroids = run.centroids.tolist() if run else [[0.0] * len(SEG_FEATURES)]
    seg = cut_lineage(assign_segment(scaled, centroids, out="cluster").select(key, "cluster"))
    scaled.unpersist()
    return relabel_by_value(seg, clv, key=key), run


def segment_summary(seg: DataFrame, clv: DataFrame, churn: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers, mean and exact median clv, churn rate per segment."""
    df = cut_lineage(seg.join(clv, key, "left").join(churn, key, "left").select("segment", key, "clv", "churn_30d"))
    base = df.groupBy("segment").agg(F.count(key).alias("customers"), F.avg("clv").alias("mean_clv"),
                                     F.avg(F.col("churn_30d").cast("double")).alias("churn_rate"))
    med = quantile_row(df, "clv", [0.5], ["median_clv"], ["segment"], cut=False)
    return base.join(med, "segment", "left").select("segment", "customers", "mean_clv", "median_clv",
                                                    "churn_rate")


def segment_profiles(seg: DataFrame, features: DataFrame, cols: Sequence[str] = SEG_FEATURES,
                     key: str = "customer_id") -> DataFrame:
    df = seg.join(features.select(key, *cols), key)
    # money columns are averaged from exact decimal sums
    return df.groupBy("segment").agg(*[(money_avg(c) if c in MONEY_COLS else F.avg(c)).alias(f"mean_{c}")
                                       for c in cols])


def pca_2d(spark: SparkSession, scaled: DataFrame, cols: Sequence[str] = SEG_FEATURES,
           key: str = "customer_id"):
    """Two principal components of the scaled features, from their Gram matrix.

    Each component's sign is fixed so that its largest absolute loading is
    positive.  Returns ``(projection, explained_variance_ratio)`` frames."""
    g = gram(scaled, cols)
    loadings, shares = g.components(2)
    parts = []
    for j in range(loadings.shape[1]):
        p = F.lit(0.0)
        for c, m, w in zip(cols, g.mean.tolist(), loadings[:, j].tolist()):
            p = p + (F.col(c) - F.lit(m)) * F.lit(w)
        parts.append(p.alias(f"pc{j + 1}"))
    ratios = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(shares)],
                                   "component int, explained_variance_ratio double")
    return scaled.select(key, *parts), ratios


def first_k_centroids(scaled: DataFrame, k: int, cols: Sequence[str] = SEG_FEATURES,
                      key: str = "customer_id") -> list[list[float]]:
    """Deterministic centroids: the scaled rows of the ``k`` smallest keys
    (a top-k, ``k`` rows to the driver)."""
    rows = scaled.orderBy(key).limit(k).select(*cols).collect()
    return [[float(r[c]) for c in cols] for r in rows]
