"""Reproducible splits, scaling and class weights.

Splits are exact and independent of partitioning: every row gets the hash
``md5(key || ':' || seed)``; the test part is the ``ceil(test_size * n)``
smallest hashes.  The cut hash is found without a global sort, four hex digits
at a time: see ``_cut_hashes``.

``smote`` balances the classes with rows between near neighbours (``operators.knn``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.numeric import safe_div
from stayrate.operators.common import scalars
from stayrate.operators.knn import knn_join
from stayrate.session import cut_lineage

PREFIX_CHARS = 4
HASH_CHARS = 32


def split_hash(key: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def _cut_hashes(hashes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(group, cut): per group the smallest hash with at least ``need`` rows at or below it.

    ``hashes`` has (g, _h), ``wanted`` (g, need).  The hash is found digit group
    by digit group: rows are counted per next ``PREFIX_CHARS`` characters, a
    window over at most 65,536 counts finds those that hold the cut, and only
    rows with that prefix are counted further, until the whole hash is known
    or one hash is left.  All groups go through the same few jobs."""
    todo = cut_lineage(wanted.where("need > 0").select("g", "need", F.lit("").alias("prefix")))
    done = None
    for length in range(PREFIX_CHARS, HASH_CHARS + 1, PREFIX_CHARS):
        h, t = hashes.alias("h"), todo.alias("t")
        held = h.join(t, F.col("h.g").eqNullSafe(F.col("t.g")) & F.col("h._h").startswith(F.col("t.prefix")))
        counts = (held.groupBy("t.g", "t.need", F.substring("h._h", 1, length).alias("prefix"))
                  .agg(F.count(F.lit(1)).alias("c"), F.min("h._h").alias("lo"), F.max("h._h").alias("hi")))
        w = Window.partitionBy("g").orderBy("prefix")
        counts = counts.withColumn("cum", F.sum("c").over(w))
        hit = cut_lineage(counts.where((F.col("cum") - F.col("c") < F.col("need")) & (F.col("cum") >= F.col("need")))
                          .select("g", (F.col("need") - F.col("cum") + F.col("c")).alias("need"), "prefix", "lo", "hi"))
        known = hit.where("lo = hi").select("g", F.col("lo").alias("cut"))
        done = known if done is None else done.unionByName(known)
        todo = hit.where("lo <> hi").select("g", "need", "prefix")
        if todo.isEmpty():
            break
    return done


def _split(hd: DataFrame, group, wanted: DataFrame) -> DataFrame:
    """Add ``split`` by the cut hash of each row's group (an expression)."""
    cuts = _cut_hashes(hd.select(group.alias("g"), "_h"), wanted).select(F.col("g").alias("_g"), F.col("cut").alias("_cut"))
    out = hd.withColumn("_of", group)
    out = out.join(cuts, F.col("_of").eqNullSafe(F.col("_g")), "left")
    return out.withColumn("split", F.when(F.col("_h") <= F.col("_cut"), F.lit("test")).otherwise(F.lit("train"))) \
              .drop("_h", "_of", "_g", "_cut")


def _cut_hash(hashes: DataFrame, need: int) -> str | None:
    """``_cut_hashes`` without groups: the one cut is a constant at every step, so nothing is joined."""
    prefix, length = "", 0
    while need > 0:
        length += PREFIX_CHARS
        held = hashes.where(F.col("_h").startswith(prefix)) if prefix else hashes
        counts = (held.groupBy(F.substring("_h", 1, length).alias("prefix"))
                  .agg(F.count(F.lit(1)).alias("c"), F.min("_h").alias("lo"), F.max("_h").alias("hi")))
        counts = counts.withColumn("cum", F.sum("c").over(Window.orderBy("prefix")))  # 65,536 prefixes at most
        hit = counts.where(F.col("cum") >= need).orderBy("prefix").first()
        if hit is None or hit["lo"] == hit["hi"]:
            return hit and hit["lo"]
        need, prefix = need - (hit["cum"] - hit["c"]), hit["prefix"]
    return None


def train_test_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                     key: str = "customer_id") -> DataFrame:
    """Adds ``split`` = 'test' for exactly ``ceil(test_size * n)`` rows when
    ``key`` is unique per row (rows sharing a key stay on one side).

    Fitting the cut costs a few small jobs; it enters the plan as a constant."""
    h = split_hash(key, seed)
    hashes = df.select(h.alias("_h"))
    cut = _cut_hash(hashes, math.ceil(hashes.count() * float(test_size)))
    return df.withColumn("split", F.when(h <= F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def stratified_allocation(class_counts: dict, test_size: float) -> dict:
    """Test rows per class: ``ceil(test_size * n)`` in total, each class its
    floored proportional share, the remainder to the largest fractional
    parts (ties by class value)."""
    n = sum(class_counts.values())
    n_test = math.ceil(n * float(test_size))
    exact = {c: n_test * k / n for c, k in class_counts.items()}
    alloc = {c: math.floor(v) for c, v in exact.items()}
    rest = n_test - sum(alloc.values())
    for c in sorted(exact, key=lambda c: (-(exact[c] - alloc[c]), c))[:rest]:
        alloc[c] += 1
    return alloc


def _allocation(counts: DataFrame, test_size: float) -> DataFrame:
    """``stratified_allocation`` of (g, n), as a frame (g, need); a row per class."""
    every = Window.partitionBy()
    n_test = F.ceil(F.sum("n").over(every) * F.lit(float(test_size)))
    exact = n_test * F.col("n") / F.sum("n").over(every)
    c = counts.withColumn("n_test", n_test).withColumn("exact", exact).withColumn("floor", F.floor("exact"))
    order = Window.orderBy(F.desc(F.col("exact") - F.col("floor")), "g")
    rest = F.col("n_test") - F.sum("floor").over(every)
    return c.select("g", (F.col("floor") + (F.row_number().over(order) <= rest).cast("int")).alias("need"))


def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, seed: int = 42,
                     key: str = "customer_id") -> DataFrame:
    """Exact stratified split: per class, the ``alloc[c]`` smallest hashes.

    Rows with a NULL label are a class of their own.  Nothing is collected and
    the number of jobs does not depend on the number of classes."""
    hd = df.withColumn("_h", split_hash(key, seed))
    counts = hd.groupBy(F.col(label).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return _split(hd, F.col(label), _allocation(counts, test_size))


def split_rates(df: DataFrame, label: str) -> DataFrame:
    """Rows and label rate per part."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                   F.avg(F.col(label).cast("double")).alias("label_rate"))


def fit_standardizer(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One-row frame of means and population standard deviations."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"{c}__std")]
    return df.agg(*aggs)


def apply_standardizer(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(x - mean) / std_pop``; a zero-variance column becomes 0.

    The fitted statistics (one row) enter the plan as constants (no join)."""
    sc = scalars(stats)
    out = {}
    for c in cols:
        m, s = sc[f"{c}__mean"], sc[f"{c}__std"]
        out[c] = F.when(s > 0, (F.col(c).cast("double") - m) / s).otherwise(F.lit(0.0))
    return df.withColumns(out)


def standardize(df: DataFrame, cols: Sequence[str], fit_where: F.Column | None = None) -> DataFrame:
    """Fit on the rows matching ``fit_where`` (e.g. the train part), apply to all."""
    fit_df = df.where(fit_where) if fit_where is not None else df
    return apply_standardizer(df, fit_standardizer(fit_df, cols), cols)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights ``n / (n_classes * n_c)`` per class."""
    cls = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = scalars(cls.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")))
    return cls.select(label, "n_c", (tot["n"].cast("double") / (tot["k"] * F.col("n_c"))).alias("weight"))


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives (the boosted model's class ratio)."""
    return df.agg(safe_div(F.count_if(F.col(label) != 1).cast("double"),
                           F.count_if(F.col(label) == 1)).alias("scale_pos_weight"))


def _parts_of_hash(*parts: str | F.Column) -> F.Column:
    """A number in [0, 2^32) from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])),
                              1, 8), 16, 10).cast("long")


def smote(train: DataFrame, label: str, cols: Sequence[str], k: int = 5, seed: int = 42,
          key: str = "customer_id") -> DataFrame:
    """Synthetic rows that bring every class to the size of the largest one.

    Returns (base, copy, neighbour, u, label, the columns): row ``copy`` of base row
    ``base`` lies the share ``u`` of the way to ``neighbour``, one of its ``k`` nearest
    rows of the class.  Base rows share the number evenly; the rest goes to those with the
    smallest ``split_hash``.  Neighbour and share come from md5 of the key, the copy and the
    seed, so they do not depend on partitioning.  Scale the columns first.

    Per class one exact neighbour join (``knn_join``); rows are copied with
    ``explode(sequence)``.  Keys must be unique.  Nulls in the columns count as 0; rows with a null
    label are left alone; a class of one row repeats it.
    """
    cols = list(cols)
    rows = train.where(F.col(label).isNotNull()).select(
        F.col(key).alias("base"), F.col(label).alias("_label"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]).alias("v"))
    rows = cut_lineage(rows)
    counts = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class
    most = max(counts.values(), default=0)
    made = [_smote_class(rows.where(F.col("_label") == F.lit(c)), n, most - n, k, seed) for c, n in sorted(counts.items()) if n < most]
    out = made[0] if made else rows.where(F.lit(False)).select(
        "base", F.lit(0).cast("long").alias("copy"), F.col("base").alias("neighbour"), F.lit(0.0).alias("u"), "_label", "v")
    for m in made[1:]:
        out = out.unionByName(m)
    return out.select("base", "copy", "neighbour", "u", F.col("_label").alias(label),
                      *[F.col("v")[i].alias(c) for i, c in enumerate(cols)])


def _smote_class(rows: DataFrame, n: int, wanted: int, k: int, seed: int) -> DataFrame:
    near, _ = knn_join(rows.select(F.col("base").alias("key"), "v"), k)
    hashed = rows.withColumn("_h", split_hash("base", seed))
    cut = _cut_hash(hashed.select("_h"), wanted % n)
    times = F.lit(wanted // n) + F.when(F.col("_h") <= F.lit(cut), 1).otherwise(0)
    copies = hashed.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("long"), times.cast("long")))))
    # At most k neighbours a row: one list.
    lists = near.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbour", "nv"))).alias("near"))
    joined = copies.join(lists, F.col("base") == F.col("key"), "left")
    pick = F.pmod(_parts_of_hash("base", "copy", F.lit(f"n{seed}")), F.greatest(F.size("near"), F.lit(1))).cast("int")
    joined = joined.withColumn("to", F.get("near", pick)).withColumn("u", _parts_of_hash("base", "copy", F.lit(f"u{seed}")) / F.lit(2.0 ** 32))
    between = F.zip_with("v", F.coalesce("to.nv", "v"), lambda a, b: a + F.col("u") * (b - a))
    return joined.select("base", "copy", F.coalesce("to.neighbour", "base").alias("neighbour"), "u", "_label", between.alias("v"))


def balanced(train: DataFrame, label: str, cols: Sequence[str], k: int = 5, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """(key, label, the columns) of the training rows and the synthetic ones; those have no key."""
    made = smote(train, label, cols, k, seed, key)
    same = [F.col(c).cast("double").alias(c) for c in cols]
    return (train.select(key, label, *same)
            .unionByName(made.select(F.lit(None).cast(train.schema[key].dataType).alias(key), label, *cols)))
