"""Mixing sources to target weights along a time-varying curriculum.

A schedule gives each source a weight that changes piecewise linearly over
training time 0..1.  Its integral is the source's weight: sources share the
tokens to train on by weight, none above ``max_repeats`` times its size, the
excess going to the others by weight.  The cumulative demand of a source is
its target times the schedule's running integral; a document whose tokens
begin at offset u of its source (in a hashed order, one epoch after the other)
is trained on at the time when the demand reaches u, the inverse of the
cumulative demand.  Documents are range-sorted by that position.

Only DataFrame functions are used.  Offsets are prefix sums in two levels
(hash buckets, then documents within a bucket), so a source that holds a third
of all rows is split over many tasks.

Defined results: null text has size 0; a null source is a source of its own
(last in order); a null id is hashed like an empty one; repeated rows are
documents of their own; sources without a schedule get nothing; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.store import keyed_rows, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a source whose offsets one task adds up, on average.
BUCKET_ROWS = 4096


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size (words), the order key and carried columns of every document, stored."""
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("key"), *carry), "sizes")


def source_sizes(sizes: DataFrame) -> DataFrame:
    """source, source_size, n_docs and rank (1.. by code point, null last)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    return (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
            .withColumn("rank", F.row_number().over(by_name)))


def cyclic_schedule(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), ramp: float = 0.5) -> DataFrame:
    """A schedule (source, t, weight): sources in order get the weights, repeating;
    odd ranks fade from (1 + ramp) to (1 - ramp) times theirs, even ranks grow."""
    base = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    tilt = F.when(F.col("rank") % 2 == 1, F.lit(ramp)).otherwise(F.lit(-ramp))
    knots = F.array(F.struct(F.lit(0.0).alias("t"), (base * (1 + tilt)).alias("weight")),
                    F.struct(F.lit(1.0).alias("t"), (base * (1 - tilt)).alias("weight")))
    return sources.select("source", F.inline(knots))


def integrate(schedule: DataFrame) -> DataFrame:
    """source, weight (the whole integral) and its linear segments with running integrals."""
    w = Window.partitionBy("source").orderBy("t")
    seg = (schedule.select("source", F.col("t").alias("t0"), F.col("weight").alias("w0"),
                           F.lead("t").over(w).alias("t1"), F.lead("weight").over(w).alias("w1"))
           .where("t1 > t0").withColumn("area", F.expr("(t1 - t0) * (w0 + w1) / 2")))
    run = Window.partitionBy("source").orderBy("t0").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("before", F.coalesce(F.sum("area").over(run), F.lit(0.0)))
    return seg.groupBy("source").agg(
        F.sum("area").alias("weight"),
        F.sort_array(F.collect_list(F.struct("before", "t0", "t1", "w0", "w1"))).alias("segments"))


def targets(sources: DataFrame, weights: DataFrame, max_repeats: float = 3.0) -> DataFrame:
    """Add ``target``: sizes shared by weight, capped, the excess shared again.

    With sources ordered by cap / weight the capped ones come first, so one
    pass over the sources (one row each) finds them: a source is capped while
    what is left, shared by weight, gives it its cap or more.
    """
    s = (sources.join(weights, F.col("source").eqNullSafe(F.col("ws")), "left")
         .withColumn("w", F.coalesce("weight", F.lit(0.0)))
         .withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
         .withColumn("ratio", F.when(F.col("w") > 0, F.try_divide("cap", "w"))))
    order = Window.orderBy(F.col("ratio").asc_nulls_last(), "rank")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("all_w", F.sum("w").over(everything))
         .withColumn("left_w", F.col("all_w") - F.coalesce(F.sum("w").over(earlier), F.lit(0.0)))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
         .withColumn("full", F.coalesce(F.col("left") * F.col("w") >= F.col("cap") * F.col("left_w"), F.lit(False)))
         .withColumn("capped", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, 0)) & (F.col("w") > 0)))
    some = lambda c: F.sum(F.when(F.col("capped"), F.col(c)).otherwise(0.0)).over(everything)
    level = F.try_divide(F.col("total") - some("cap"), F.col("all_w") - some("w"))
    s = s.withColumn("level", level)
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(
        F.coalesce(F.col("w") * F.col("level"), F.lit(0.0))))


def mix(sizes: DataFrame, schedule: DataFrame | None = None, max_repeats: int = 3) -> DataFrame:
    """Mix measured documents by a schedule (source, t, weight); range-sorted by position.

    Returns doc_id, source, size, source_size, target, taken (words, repeats
    counted), copies, positions (training time of each copy) and position (the
    first; null if the mix does not take the document).  A copy is taken when
    its middle lies below its source's target, so a source misses its target
    by at most half a document, and no document is taken more than
    ``max_repeats`` times.
    """
    sources = source_sizes(sizes)
    segments = integrate(cyclic_schedule(sources) if schedule is None else schedule)
    aims = materialize(targets(sources, segments.withColumnRenamed("source", "ws"), max_repeats)
                       .select(F.col("source").alias("s"), "source_size", "target", "weight", "segments"), "targets")
    n = sizes.count()
    digits = max(0, math.ceil(math.log(max(n, 1) / BUCKET_ROWS, 16)))
    keyed = sizes.withColumn("bucket", F.substring("key", 1, digits))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("bs"), F.col("bucket").alias("bb"),
                       F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (keyed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(sums, F.col("source").eqNullSafe(F.col("bs")) & (F.col("bucket") == F.col("bb")))
              .withColumn("start", F.col("base") + F.col("within")))
    d = placed.join(aims, F.col("source").eqNullSafe(F.col("s")))
    starts = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_repeats - 1)),
                                  lambda k: k * F.col("source_size") + F.col("start")),
                      lambda u: u + F.col("size") / 2 < F.col("target"))
    d = d.withColumn("starts", starts).withColumn("copies", F.size("starts"))
    d = d.withColumn("positions", F.transform("starts", _time_of))
    carried = [c for c in sizes.columns if c not in ("doc_id", "source", "size", "key")]
    d = d.select("doc_id", "source", "size", "source_size", "target", *carried,
                 (F.col("size") * F.col("copies")).alias("taken"), "copies", "positions",
                 F.try_element_at("positions", F.lit(1)).alias("position"), "key")
    return d.orderBy(F.col("position").asc_nulls_last(), "key").drop("key")


def _time_of(u: Column) -> Column:
    """The time at which the source's cumulative demand reaches u."""
    y = F.try_divide(u * F.col("weight"), F.col("target"))
    seg = F.element_at(F.filter("segments", lambda g: (g["before"] <= y) | (g["t0"] <= 0)), -1)
    rest = y - seg["before"]
    slope = (seg["w1"] - seg["w0"]) / (seg["t1"] - seg["t0"])
    # rest = w0 x + slope x^2 / 2, solved for x without cancellation
    x = F.try_divide(2 * rest, seg["w0"] + F.sqrt(F.greatest(seg["w0"] * seg["w0"] + 2 * slope * rest, F.lit(0.0))))
    return F.least(seg["t0"] + F.coalesce(x, F.lit(0.0)), seg["t1"])


def mix_documents(docs: DataFrame, max_repeats: int = 3) -> DataFrame:
    """``mix`` with the cyclic schedule over all documents of a table."""
    return mix(measured(docs), max_repeats=max_repeats)


def training_order(docs: DataFrame, max_repeats: int = 3, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """The documents' rows, one per copy that the mix takes, range-sorted by training position."""
    keyed = keyed_rows(docs, id_col, text_col, F.col(source_col).cast("string").alias("source"))
    sizes = measured(keyed, carry=("row_key",))
    copies = materialize(mix(sizes, max_repeats=max_repeats).where("copies > 0").select(
        F.col("doc_id").alias("c_id"), F.col("row_key").alias("c_key"), F.explode("positions").alias("at")), "copies")
    if not sizes.groupBy("doc_id", "row_key").count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(["doc_id", "row_key"])  # their copies are all listed
    rows = keyed.join(copies, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("row_key") == F.col("c_key")))
    return rows.orderBy("at", "row_key").select("row.*")
