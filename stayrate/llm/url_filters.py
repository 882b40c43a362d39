"""URL filters: a temporal join of captures with dated list entries.

List histories (entry added on a day, removed on a day, added again ...) become
validity intervals, and an as-of join evaluates every capture against the
entries that were active on the day it was fetched.  Entries name a domain
(they cover the host and all hosts below it) or one URL.

Captures are first reduced to the different (host, day) and (URL, day) pairs,
with partial aggregation before the shuffle, so a host that a third of all
captures come from is a few rows per task; the as-of join works on these, and
its hits join back to the captures (a join that AQE splits where it is
skewed).

Defined results: a null or unparsable URL, and a capture without a fetch time,
match nothing; entries without list, pattern or day are ignored; of several
actions on one entry on one day, "add" wins; repeated captures are rows of
their own; empty tables give empty or unblocked results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_REST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^#]*)"


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and closing dots; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, _HOST, 1)), r"\.+$", "")
    return F.nullif(host, F.lit(""))


def url_key(url: Column) -> Column:
    """Host, path and query; scheme, user, port and fragment do not count."""
    rest = F.regexp_extract(url, _REST, 1)
    return F.concat(host_of(url), F.when(rest == "", F.lit("/")).otherwise(rest))


def intervals(history: DataFrame) -> DataFrame:
    """(list, kind, pattern, day, action) as intervals valid_from <= day < valid_to (null: open)."""
    events = (history.select("list", "kind", F.lower("pattern").alias("pattern"), F.col("day").cast("date").alias("day"),
                             (F.col("action") == "add").alias("on"))
              .where("list IS NOT NULL AND kind IS NOT NULL AND pattern IS NOT NULL AND day IS NOT NULL AND on IS NOT NULL")
              .groupBy("list", "kind", "pattern", "day").agg(F.max("on").alias("on")))
    w = Window.partitionBy("list", "kind", "pattern").orderBy("day")
    # Only changes count; an interval lasts until the next change.
    changes = events.withColumn("was", F.coalesce(F.lag("on").over(w), F.lit(False))).where("on <> was")
    return (changes.withColumn("valid_to", F.lead("day").over(w)).where("on")
            .select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to"))


def _active(lookups: DataFrame, spans: DataFrame, kind: str) -> DataFrame:
    """As-of join: (key, day, list, pattern) of entries active at each lookup (key, pattern, day)."""
    s = spans.where(F.col("kind") == kind).select("list", F.col("pattern").alias("p"), "valid_from", "valid_to")
    on = ((F.col("pattern") == F.col("p")) & (F.col("valid_from") <= F.col("day"))
          & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    return lookups.join(s, on).select("key", "day", "list", "pattern")


def _verdicts(active: DataFrame, name: str) -> DataFrame:
    return (active.groupBy("key", "day").agg(F.sort_array(F.collect_set("list")).alias(f"{name}_lists"),
                                             F.count(F.lit(1)).alias(f"{name}_hits"))
            .select(F.col("key").alias(f"{name}_key"), F.col("day").alias(f"{name}_day"), f"{name}_lists", f"{name}_hits"))


def filter_urls(captures: DataFrame, history: DataFrame, url_col: str = "url", time_col: str = "fetched_at",
                carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the carried columns), host, day, lists (of the active entries that
    match, in order), n_hits (such entries) and blocked, for every capture."""
    row = F.struct(*(carry or captures.columns)).alias("row")
    c = captures.select(row, host_of(F.col(url_col)).alias("host"), F.lower(url_key(F.col(url_col))).alias("target"),
                        F.col(time_col).cast("date").alias("day"))
    spans = intervals(history)
    hosts = c.where("host IS NOT NULL AND day IS NOT NULL").groupBy(F.col("host").alias("key"), "day").agg(F.lit(1).alias("x"))
    labels = F.split("key", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    by_domain = _active(hosts.select("key", "day", F.explode(above).alias("pattern")), spans, "domain")
    urls = c.where("target IS NOT NULL AND day IS NOT NULL").groupBy(F.col("target").alias("key"), "day").agg(F.lit(1).alias("x"))
    by_url = _active(urls.select("key", "day", F.col("key").alias("pattern")), spans, "url")
    out = (c.join(_verdicts(by_domain, "d"), (F.col("host") == F.col("d_key")) & (F.col("day") == F.col("d_day")), "left")
           .join(_verdicts(by_url, "u"), (F.col("target") == F.col("u_key")) & (F.col("day") == F.col("u_day")), "left"))
    none = F.array().cast("array<string>")
    lists = F.array_sort(F.array_union(F.coalesce("d_lists", none), F.coalesce("u_lists", none)))
    hits = F.coalesce("d_hits", F.lit(0)) + F.coalesce("u_hits", F.lit(0))
    return out.select("row", "host", "day", lists.alias("lists"), hits.cast("long").alias("n_hits"), (hits > 0).alias("blocked"))
