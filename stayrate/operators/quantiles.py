"""Exact quantiles without gathering a whole group in one task.

``percentile`` / ``median`` are exact but keep every distinct value of a group
in one task's memory.  Here each wanted order statistic has a bracket
``[lo, hi]`` of values that holds it, at first the group's minimum and maximum.
One pass counts the values of each bracket in ``BUCKETS`` equal steps (with
partial aggregation, so a group is at most that many rows per task in the
shuffle) and the bracket shrinks to the smallest and largest value of the step
that holds the rank.  Brackets of at most ``RANK_ROWS`` rows, or of one value,
are done; the passes go on for the others, each bracket by its own size.  What
is left in the brackets is ranked in a window of that bounded size.

Interpolation is linear between the two neighbouring order statistics (the
default of ``numpy.percentile`` / ``pandas.quantile``).  Nulls and NaN do not
count; a group without values has no rows; a null group key is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.session import cut_lineage

BUCKETS = 4096
#: Rows of one bracket that a task ranks.
RANK_ROWS = 50_000
_LARGEST = 1.7976931348623157e308


def _lerp(a, b, t):
    # numpy's _lerp: a + (b-a)*t, evaluated from the nearer end for t >= 0.5
    d = b - a
    return F.when(t >= F.lit(0.5), b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def _step(v: str, lo: str, hi: str):
    """Which of the equal steps of [lo, hi] a value is in (halves, as the range may overflow)."""
    half = lambda c: F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2
    share = F.try_divide(half(v) - half(lo), half(hi) - half(lo))
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    cut: bool = True, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Long form: ``by..., p, quantile`` with one row per group and probability."""
    keys = [f"g{i}" for i in range(len(by))]
    v = F.col(value).cast("double")
    data = df.where(v.isNotNull() & ~F.isnan(v)).select(*[F.col(c).alias(k) for c, k in zip(by, keys)], v.alias("v"))
    # The passes read the values several times: write the projected columns
    # once instead of re-running the upstream pipeline for each pass.
    if cut:
        data = cut_lineage(data)
    group = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    ranks = [F.struct(F.lit(i).alias("i"), F.floor((F.col("n") - 1) * F.lit(float(p))).alias("k"))
             for i, p in enumerate(probs)]
    both = F.array(*ranks, *[F.struct(r["i"].alias("i"), F.least(r["k"] + 1, F.col("n") - 1).alias("k")) for r in ranks])
    wanted = (group.select(*keys, "n", "lo", "hi", F.explode(F.array_distinct(F.transform(both, lambda r: r["k"]))).alias("k"))
              .select(*keys, "k", "lo", "hi", F.lit(0).cast("bigint").alias("below"), F.col("n").alias("inside")))
    wanted = cut_lineage(wanted)
    large = (F.col("inside") > rank_rows) & (F.col("lo") < F.col("hi"))
    done = wanted.where(~large)
    wanted = wanted.where(large)
    while not wanted.isEmpty():
        steps = (_matching(data, wanted, keys).groupBy(*keys, "lo", "hi", _step("v", "lo", "hi").alias("step"))
                 .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("a"), F.max("v").alias("b")))
        order = Window.partitionBy(*keys, "lo", "hi").orderBy("step")  # at most BUCKETS rows
        steps = steps.withColumn("before", F.sum("c").over(order) - F.col("c"))
        w, s = wanted.alias("w"), steps.alias("s")
        on = ((F.col("w.lo") == F.col("s.lo")) & (F.col("w.hi") == F.col("s.hi"))
              & (F.col("w.below") + F.col("s.before") <= F.col("w.k")) & (F.col("w.k") < F.col("w.below") + F.col("s.before") + F.col("s.c")))
        for k in keys:
            on = on & F.col(f"w.{k}").eqNullSafe(F.col(f"s.{k}"))
        shrunk = cut_lineage(w.join(s, on).select(*[F.col(f"w.{k}") for k in keys], "w.k", F.col("s.a").alias("lo"),
                                                  F.col("s.b").alias("hi"), (F.col("w.below") + F.col("s.before")).alias("below"),
                                                  F.col("s.c").alias("inside")))
        done, wanted = done.unionByName(shrunk.where(~large)), shrunk.where(large)
    one = done.where("lo = hi").select(*keys, "k", F.col("lo").alias("x"))
    few = done.where("lo < hi")
    order = Window.partitionBy(*keys, "lo", "hi").orderBy("v")  # at most rank_rows rows
    inside = _matching(data, few, keys).withColumn("r", F.row_number().over(order) - 1).alias("s")
    w = few.alias("w")
    on = (F.col("w.lo") == F.col("s.lo")) & (F.col("w.hi") == F.col("s.hi")) & (F.col("w.k") - F.col("w.below") == F.col("s.r"))
    for k in keys:
        on = on & F.col(f"w.{k}").eqNullSafe(F.col(f"s.{k}"))
    found = one.unionByName(w.join(inside, on).select(*[F.col(f"w.{k}") for k in keys], "w.k", F.col("s.v").alias("x")))
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("x"))  # 2 per probability
    out = group.alias("g").join(found.alias("f"), _same(group.alias("g"), found.alias("f"), keys) if keys else F.lit(True))
    out = out.select(*[F.col(f"g.{k}").alias(c) for c, k in zip(by, keys)], "g.n", "f.x",
                     F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"))
    h = (F.col("n") - 1).cast("double") * F.col("p")
    low, high = F.floor(h), F.least(F.floor(h) + 1, F.col("n") - 1)
    return out.select(*by, "p", _lerp(F.col("x")[low], F.col("x")[high], h - F.floor(h)).alias("quantile"))


def _matching(data: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values with the brackets (lo, hi) of their group that hold them; equal brackets count once."""
    sets = wanted.groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("brackets"))  # 2 per probability
    d, s = data.alias("d"), sets.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"d.{k}").eqNullSafe(F.col(f"b.{k}"))
    if keys:
        both = d.join(s, on)
    else:
        row = sets.first()  # without groups: one row
        both = d.withColumn("brackets", F.array(*[F.struct(F.lit(x["lo"]).alias("lo"), F.lit(x["hi"]).alias("hi"))
                                                  for x in row["brackets"]]) if row and row["brackets"] else
                            F.array().cast("array<struct<lo:double,hi:double>>"))
    held = F.filter("brackets", lambda x: (x["lo"] <= F.col("v")) & (F.col("v") <= x["hi"]))
    return both.select(*[F.col(f"d.{k}") for k in keys], "v", F.inline(held))


def quantile_row(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                 by: Sequence[str] = (), cut: bool = True, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Wide form: one row per group with one column per probability."""
    long = exact_quantiles(df, value, probs, by, cut=cut, rank_rows=rank_rows)
    aggs = [F.max(F.when(F.col("p") == F.lit(float(p)), F.col("quantile"))).alias(n)
            for p, n in zip(probs, names)]
    if by:
        return long.groupBy(*by).agg(*aggs)
    return long.agg(*aggs)
