"""The stages of the corpus pipeline: each calls one operator on all documents it gets."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayrate.llm import quality_classifier as classifier
from stayrate.llm.mixing import training_order
from stayrate.llm.packing import pack_documents
from stayrate.llm.quality_rules import judge
from stayrate.llm.simhash import deduplicate

SEQUENCE_TOKENS = 2048
#: Ends each document of a packed sequence.
END_ID = 0
#: Documents with a quality score below it go.
LEAST_QUALITY = 0.3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and lie in their language's perplexity band."""
    return judge(docs, docs.columns).where("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of those still there, accepts."""
    labels = classifier.training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = classifier.score(docs, classifier.fit(docs, labels), docs.columns)
    return scored.where(scored["score"] >= LEAST_QUALITY).select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 3-word SimHashes differ in 3 bits or fewer."""
    return deduplicate(docs, shingle=3, bits=3)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once per copy that the mix takes."""
    return training_order(docs, max_repeats=3)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS, END_ID)
