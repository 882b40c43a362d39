"""Queries: segmentation.

``assign_segment`` and the summaries over it use deterministic centroids (the
scaled rows of the four smallest customer ids), so they carry SQL oracles;
the K-Means, elbow and PCA queries are checked by properties in the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import segments as sg
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import R, finish, register
from stayrate.plans.sqlparts import with_features
from stayrate.session import cut_lineage
from stayrate.sources.fixtures import fixture

COLS = sg.SEG_FEATURES
K = 4
N_INIT = 10

SCALED_SQL = f""",
sst AS (SELECT {", ".join(f"avg(CAST(coalesce({c}, 0) AS DOUBLE)) AS m_{c}, "
                          f"stddev_pop(CAST(coalesce({c}, 0) AS DOUBLE)) AS s_{c}" for c in COLS)} FROM feat),
z AS (SELECT customer_id, {", ".join(
    f"CASE WHEN s_{c} > 0 THEN (CAST(coalesce({c}, 0) AS DOUBLE) - m_{c}) / s_{c} ELSE 0.0 END AS {c}"
    for c in COLS)} FROM feat, sst)
"""
ASSIGN_SQL = SCALED_SQL + f""",
cen AS (SELECT row_number() OVER (ORDER BY customer_id) - 1 AS idx, * FROM
          (SELECT * FROM z ORDER BY customer_id LIMIT {K})),
dd AS (SELECT z.customer_id, cen.idx, {" + ".join(f"(z.{c} - cen.{c}) * (z.{c} - cen.{c})" for c in COLS)} AS dist
       FROM z, cen),
seg AS (SELECT customer_id, CAST(min(idx) AS INTEGER) AS segment FROM
          (SELECT *, min(dist) OVER (PARTITION BY customer_id) AS md FROM dd) WHERE dist = md
        GROUP BY customer_id)
"""


def scaled_df(spark, sf):
    return sg.segment_features(features_df(spark, sf))


def stored_features(spark, sf):
    """The segmentation columns, made once for queries that read them more than once."""
    return cut_lineage(features_df(spark, sf).select("customer_id", *COLS))


def assigned(spark, sf, features=None):
    scaled = scaled_df(spark, sf) if features is None else sg.segment_features(features)
    cents = sg.first_k_centroids(scaled, K)
    return sg.assign_segment(scaled, cents).select("customer_id", "segment")


@register("segment_features", with_features() + SCALED_SQL + "SELECT customer_id, " +
          ", ".join(f"{R(c)} AS {c}" for c in COLS) + " FROM z")
def q_segment_features(spark, sf):
    """The eight segmentation columns, 0-filled and standardized."""
    return finish(scaled_df(spark, sf))


@register("assign_segment", with_features() + ASSIGN_SQL + "SELECT customer_id, segment FROM seg")
def q_assign_segment(spark, sf):
    """Nearest of four fixed centroids (the scaled rows of the 4 smallest ids)."""
    return assigned(spark, sf)


@register("segment_summary", with_features("f_clv_labels", "f_churn_labels") + ASSIGN_SQL + f"""
SELECT s.segment, count(s.customer_id) AS customers, {R("avg(l.clv)")} AS mean_clv,
  {R("quantile_cont(l.clv, 0.5)")} AS median_clv, {R("avg(CAST(h.churn_30d AS DOUBLE))")} AS churn_rate
FROM seg s LEFT JOIN f_clv_labels l ON s.customer_id = l.customer_id
LEFT JOIN f_churn_labels h ON s.customer_id = h.customer_id GROUP BY s.segment""")
def q_segment_summary(spark, sf):
    fx = fixture(spark, sf)
    return finish(sg.segment_summary(assigned(spark, sf), fx.clv_labels, fx.churn_labels))


MONEY = {"monthly_fee", "monetary"}


def _mean_sql(c: str) -> str:
    if c in MONEY:
        return f"CAST(sum(CAST(f.{c} AS DECIMAL(18,4))) AS DOUBLE) / count(f.{c})"
    return f"avg(f.{c})"


@register("segment_profiles", with_features() + ASSIGN_SQL + "SELECT s.segment, " + ", ".join(
    f"{R(_mean_sql(c))} AS mean_{c}" for c in COLS) +
    " FROM seg s JOIN feat f ON s.customer_id = f.customer_id GROUP BY s.segment")
def q_segment_profiles(spark, sf):
    feats = stored_features(spark, sf)
    return finish(sg.segment_profiles(assigned(spark, sf, feats), feats))


_cache: dict = {}


def _kmeans(spark, sf, features=None, clv=None):
    """``features`` and ``clv`` are given by queries that read them themselves too."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _cache:
        feats = features_df(spark, sf) if features is None else features
        _cache[key] = sg.kmeans_segments(feats, fixture(spark, sf).clv_labels if clv is None else clv, K, N_INIT)
    return _cache[key]


@register("kmeans_segments")
def q_kmeans_segments(spark, sf):
    """Best of 10 K-Means runs (k = 4), segments relabelled by mean clv."""
    return _kmeans(spark, sf)[0]


@register("kmeans_segment_summary")
def q_kmeans_segment_summary(spark, sf):
    fx = fixture(spark, sf)
    clv = cut_lineage(fx.clv_labels)  # for the order of the segments and for their means
    return finish(sg.segment_summary(_kmeans(spark, sf, clv=clv)[0], clv, fx.churn_labels))


@register("elbow")
def q_elbow(spark, sf):
    """Inertia of the best of 10 runs for k = 2 .. 10."""
    return finish(sg.elbow(scaled_df(spark, sf), range(2, 11), N_INIT))


@register("pca_2d")
def q_pca_2d(spark, sf):
    proj, _ = sg.pca_2d(spark, scaled_df(spark, sf))
    return finish(proj)


@register("pca_explained_variance")
def q_pca_explained_variance(spark, sf):
    _, ratios = sg.pca_2d(spark, scaled_df(spark, sf))
    return finish(ratios)


@register("segment_scatter")
def q_segment_scatter(spark, sf):
    """Data behind the segment scatter: PCA coordinates with the K-Means segment."""
    feats = stored_features(spark, sf)
    proj, _ = sg.pca_2d(spark, sg.segment_features(feats))
    return finish(proj.join(_kmeans(spark, sf, feats)[0], "customer_id").select(
        "customer_id", "pc1", "pc2", F.col("segment")))
