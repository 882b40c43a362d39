"""The corpus pipeline: documents to packed training sequences in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each stage's rows to the shared checkpoint folder and reads them back
as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayrate.llm import stages
from stayrate.llm.store import materialize

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", stages.quality_rules),
    ("quality_classifier", stages.quality_classifier),
    ("simhash_dedup", stages.simhash_dedup),
    ("source_mixing", stages.source_mixing),
    ("best_fit_packing", stages.best_fit_packing),
]

#: Perplexity, a trained classifier, XXH64 bits and BPE ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
