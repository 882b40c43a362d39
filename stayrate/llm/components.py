"""Connected components of links, as alternating star joins on Spark.

Every round replaces each node's edges by edges to its smallest neighbour
(large star: the larger neighbours; small star: the smaller ones and itself),
until the edges are one star per component.  Rounds are stored in the shared
folder, so no lineage grows and a lost executor repeats one round at most.
Nothing but a count and a checksum of a round reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.store import materialize


def merge_links(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i], in place; ``label`` points at set minima."""
    while True:
        ra, rb = label[a], label[b]
        differ = ra != rb
        if not differ.any():
            return
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); component is its smallest node.

    Self links and null ends are ignored; repeated edges count once; no edges
    give an empty result.
    """
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u IS NOT NULL AND v IS NOT NULL AND u > v").distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                 .union(low.select("u", F.col("m").alias("v")))).distinct()
        e = materialize(small, "edges")
        last, mark = mark, _mark(e)
        if mark == last:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _mark(e: DataFrame) -> tuple[int, int]:
    r = e.agg(F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], int(r["s"] or 0)
