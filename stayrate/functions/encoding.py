"""Categorical encoders: alphabetical label codes, dummy columns and sparse dummies.

Codes come from a distributed dictionary (``dictionary``): the distinct levels are
range-partitioned and sorted, and a level's code is its place in its partition plus the
levels of the partitions before it.  No list of levels reaches the driver, except where
each level becomes a column of the result or a plan constant: there at most ``MAX_LEVELS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.session import cut_lineage

#: Levels of a column that may become columns or constants of a plan.
MAX_LEVELS = 1_000


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(level, code): the distinct non-null values, numbered from 0 in ascending order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    levels = df.select(F.col(col).alias("level")).where("level IS NOT NULL").distinct()
    # Ids of range partitions are in order; within one they count from 0.
    placed = cut_lineage(levels.repartitionByRange(n, "level").sortWithinPartitions("level").select(
        "level", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row per partition
    before = sizes.select(F.col("part").alias("of"), (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    return placed.join(F.broadcast(before), F.col("part") == F.col("of")).select("level", (F.col("before") + F.col("at")).alias("code"))


def label_encode(df: DataFrame, col: str, out: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Alphabetical integer code (``LabelEncoder`` order: sorted distinct values); null and
    values that are not in ``codes`` (a ``dictionary``, of ``df`` itself by default) get the number of levels."""
    out = out or f"{col}_encoded"
    codes = cut_lineage(codes if codes is not None else dictionary(df, col))
    named = codes.select(F.col("level").alias("_level"), F.col("code").alias("_code"))
    return (df.join(named, F.col(col) == F.col("_level"), "left")
            .withColumn(out, F.coalesce("_code", F.lit(codes.count())).cast("int")).drop("_level", "_code"))


def one_hot_vector(df: DataFrame, col: str, out: str | None = None, codes: DataFrame | None = None) -> DataFrame:
    """Adds a sparse vector with a place per level, none dropped, and a last one for null and unseen values."""
    out = out or f"{col}_vector"
    codes = cut_lineage(codes if codes is not None else dictionary(df, col))
    size = codes.count()
    # Fitted on the largest code alone: its metadata is the number of levels.
    last = df.sparkSession.createDataFrame([(float(max(size - 1, 0)),)], "_index double")
    encoder = OneHotEncoder(inputCols=["_index"], outputCols=[out], dropLast=False, handleInvalid="keep").fit(last)
    coded = label_encode(df, col, "_index", codes).withColumn("_index", F.col("_index").cast("double"))
    return encoder.transform(coded).drop("_index")


def distinct_levels(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values, ``MAX_LEVELS`` at most: each becomes a column."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        raise ValueError(f"{col} has more than {MAX_LEVELS} levels: use one_hot_vector")
    return sorted(r[0] for r in rows)


def fit_levels(df: DataFrame, cols: Sequence[str]) -> dict[str, list | None]:
    """Sorted distinct values of several categorical columns in one job; None where
    there are more than ``MAX_LEVELS`` in all (one more reaches the driver at most)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in cols])).alias("p")
    found = df.select(pairs).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct()
    rows = found.limit(MAX_LEVELS + 1).collect()
    if len(rows) > MAX_LEVELS:
        large = {r["c"]: r["n"] for r in found.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
        return {c: None if large.get(c, 0) > MAX_LEVELS else distinct_levels(df, c) for c in cols}
    levels: dict[str, list | None] = {c: [] for c in cols}
    for r in rows:
        levels[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in levels.items()}


def encode_with_levels(col: str, levels: Sequence[str]) -> Column:
    """Alphabetical code of ``col`` given its fitted levels (NULL if unseen)."""
    if not levels:
        return F.lit(None).cast("int")
    m = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(v), F.lit(i))])
    return m[F.col(col).cast("string")]


def one_hot(df: DataFrame, col: str, values: Sequence[str] | None = None,
            prefix: str | None = None) -> DataFrame:
    """``<prefix>_<value>`` 0/1 columns, one per level, none dropped (many levels: ``one_hot_vector``).

    Pass ``values`` so that train and score frames get the same columns and
    the plan needs no extra job; otherwise the sorted distinct levels are used.
    """
    prefix = prefix or col
    levels = list(values) if values is not None else distinct_levels(df, col)
    return df.withColumns({f"{prefix}_{v}": (F.col(col) == F.lit(v)).cast("int")
                           for v in sorted(levels)})
