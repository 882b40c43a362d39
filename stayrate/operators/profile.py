"""Table profiles and distribution summaries.

Each profile is one or two aggregate passes over a projection of the input.
Only schema metadata and fitted constants (one-row aggregates such as a
range or the means) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.numeric import money_avg
from stayrate.operators.common import attach, scalars
from stayrate.operators.gram import gram
from stayrate.operators.quantiles import quantile_row
from stayrate.session import cut_lineage


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and column count per table (one partial count per scan)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols"))
        out = one if out is None else out.unionByName(one)
    return out


def column_profile(df: DataFrame, table: str = "") -> DataFrame:
    """Type and null count of every column: a single aggregate, then unpivot."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    stacked = counts.unpivot([], list(df.columns), "column_name", "null_count")
    type_map = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return stacked.select(F.lit(table).alias("table_name"), "column_name",
                          type_map[F.col("column_name")].alias("data_type"),
                          F.col("null_count").cast("bigint").alias("null_count"))


def head_rows(df: DataFrame, n: int = 3, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stable order (top-n per task, then merged)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def describe(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max (``pandas.describe``)."""
    # one checkpointed projection feeds both the moments and the quantiles
    src = cut_lineage(df.where(F.col(col).isNotNull()).select(*by, col))
    basic = src.groupBy(*by).agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"))
    q = quantile_row(src, col, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], by, cut=False)
    out = basic.join(q, list(by)) if by else attach(basic, q)
    return out.select(*by, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def fee_summary(customers: DataFrame, clv: DataFrame) -> DataFrame:
    """Mean / median / std of the monthly fee and min / max / mean clv."""
    f = customers.agg(money_avg("monthly_fee").alias("fee_mean"), F.stddev_samp("monthly_fee").alias("fee_std"))
    med = scalars(quantile_row(customers, "monthly_fee", [0.5], ["fee_median"]))["fee_median"]
    c = scalars(clv.agg(F.min("clv").alias("mn"), F.max("clv").alias("mx"), F.avg("clv").alias("avg")))
    c_min, c_max, c_mean = c["mn"], c["mx"], c["avg"]
    return f.select("fee_mean", med.alias("fee_median"), "fee_std", c_min.alias("clv_min"),
                    c_max.alias("clv_max"), c_mean.alias("clv_mean"))


def _numeric(df: DataFrame, col: str):
    t = dict(df.dtypes)[col]
    if t == "date":
        return F.unix_date(F.col(col)).cast("double")
    if t.startswith("timestamp"):
        return F.unix_date(F.col(col).cast("date")).cast("double")
    return F.col(col).cast("double")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between min and max with ``bins`` bins, the last
    bin closed (``numpy.histogram``); empty bins are reported with 0.

    Bin edges are ``min + i * (max - min) / bins``; a value on an inner edge
    belongs to the bin on its right.  Dates are binned by day number.  When
    all values are equal numpy widens the range to ``[v - 0.5, v + 0.5]``.
    """
    x = df.select(_numeric(df, col).alias("x")).where(F.col("x").isNotNull())
    rng = scalars(x.agg(F.min("x").alias("mn"), F.max("x").alias("mx")))
    mn, mx = rng["mn"], rng["mx"]
    lo = F.when(mn == mx, mn - F.lit(0.5)).otherwise(mn)
    hi = F.when(mn == mx, mx + F.lit(0.5)).otherwise(mx)
    n = F.lit(bins)
    step = (hi - lo) / n

    def edge(i):
        return F.when(i >= n, hi).otherwise(lo + i.cast("double") * step)

    raw = F.floor((F.col("x") - lo) / (hi - lo) * n.cast("double")).cast("int")
    idx = F.least(F.greatest(raw, F.lit(0)), n - 1)
    xb = x.withColumn("b0", idx)
    xb = xb.withColumn("b1", F.when(F.col("x") < edge(F.col("b0")), F.col("b0") - 1).otherwise(F.col("b0")))
    xb = xb.withColumn("bin", F.when((F.col("x") >= edge(F.col("b1") + 1)) & (F.col("b1") != n - 1),
                                     F.col("b1") + 1).otherwise(F.col("b1")))
    counts = xb.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    # Fixed number of bins: a proven bound, so this frame may be broadcast.
    all_bins = x.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = all_bins.join(counts, "bin", "left").fillna(0, ["count"])
    return out.select("bin", edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
                      F.col("count").cast("bigint").alias("count"))


def boxplot_stats(df: DataFrame, col: str, by: Sequence[str] = (), whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the furthest datum within ``whis`` IQR of the
    box, and the number of points beyond (matplotlib's box plot)."""
    by = list(by)
    data = cut_lineage(df.where(F.col(col).isNotNull()).select(*by, F.col(col).cast("double").alias("x")))
    q = quantile_row(data, "x", [0.25, 0.5, 0.75], ["q1", "median", "q3"], by, cut=False)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumns({"lo_fence": F.col("q1") - F.lit(whis) * F.col("iqr"),
                       "hi_fence": F.col("q3") + F.lit(whis) * F.col("iqr")})
    j = data.join(q, by) if by else attach(data, q)
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    agg = j.groupBy(*by, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return agg.select(*by, "n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high", "n_outliers")


def correlation_matrix(df: DataFrame, cols: Sequence[str], fill_zero: bool = True) -> DataFrame:
    """Pearson correlations, long form, lower triangle with the diagonal.

    From the Gram matrix of the columns (``operators.gram``: one aggregate of one vector,
    centred, so numerically stable); the projected columns are checkpointed once.  A
    constant column gives NULL instead of an ANSI division error.  Without
    ``fill_zero`` rows with a null in any column are left out.
    """
    cols = list(cols)
    src = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    if fill_zero:
        src = src.fillna(0.0)
    corr = gram(cut_lineage(src), cols).correlation()
    rows = [(a, cols[j], None if math.isnan(corr[i, j]) else float(corr[i, j])) for i, a in enumerate(cols) for j in range(i + 1)]
    return df.sparkSession.createDataFrame(rows, "var1 string, var2 string, corr double")
