"""The registered queries of the training-data operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import quality_classifier, toxicity
from stayrate.llm.embeddings import embedding_links
from stayrate.llm.learned_partitions import nearest_neighbours
from stayrate.llm.mixing import mix_documents
from stayrate.llm.negatives import hard_negatives
from stayrate.llm.packing import pack_documents
from stayrate.llm.quality_rules import judge
from stayrate.llm.simhash import simhash_documents
from stayrate.llm.spelling import spelling_variants
from stayrate.llm.token_files import read_token_files, write_token_files
from stayrate.llm.url_filters import filter_urls
from stayrate.llm.warc import read_warc, write_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(c: str) -> F.Column:
    return (F.floor(F.col(c) * 1e6 + 0.5) / 1e6).alias(c)


@_query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by a curriculum of mean weights 1, 2, 3 over the sources in order."""
    mixed = mix_documents(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", _rounded("target"), "taken", "copies")


ORACLES["op1_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS sz, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source),
-- a source is above 3 times its size when the level (target per weight) that uses up all sizes is above its own ratio
lv AS (
  SELECT a.sz * 3 / a.w AS r, sum(least(3 * b.sz, b.w * (a.sz * 3 / a.w))) AS used FROM s a, s b GROUP BY a.source, a.sz, a.w),
tot AS (SELECT sum(sz) AS t FROM s),
edge AS (SELECT coalesce(max(r) FILTER (used <= t), 0) AS r FROM lv, tot),
lev AS (
  SELECT (max(t) - sum(CASE WHEN sz * 3 / w <= r THEN 3 * sz ELSE 0 END))
         / nullif(sum(CASE WHEN sz * 3 / w <= r THEN 0 ELSE w END), 0) AS l, max(r) AS r FROM s, tot, edge),
g AS (SELECT source, sz, CASE WHEN sz * 3 / w <= r THEN 3 * sz ELSE w * l END AS target FROM s, lev),
p AS (
  SELECT doc_id, d.source, size, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d),
c AS (
  SELECT p.*, g.sz, g.target, (start + size / 2.0 < target)::INT + (start + sz + size / 2.0 < target)::INT
         + (start + 2 * sz + size / 2.0 < target)::INT AS copies
  FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, sz::BIGINT AS source_size, floor(target * 1e6 + 0.5) / 1e6 AS target,
       (size * copies)::BIGINT AS taken, copies FROM c
"""


@_query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents tokenized, cut at 2,048 ids and packed into sequences."""
    packed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to token files in ascending id order and read back."""
    manifest = write_token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_token_files(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    manifest = write_warc(_table(spark, sf_dir, "pages"))
    return read_warc(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with 3-word SimHash fingerprints, linked at 3 or fewer differing bits."""
    return simhash_documents(_table(spark, sf_dir, "documents"), shingle=3, bits=3)


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row's positives, over all rows."""
    x = F.transform("embedding", lambda e: F.floor(256 * e.cast("double")).cast("double"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), x.alias("v"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@_query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every hundredth row, found through learned partitions of all rows."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of all documents with their commoner near word and the last word that such forms lead to."""
    return spelling_variants(_table(spark, sf_dir, "documents"))


@_query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings linked at a cosine of 0.95 or more, one of each group kept."""
    return embedding_links(_table(spark, sf_dir, "embeddings"), threshold=0.95)


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by text counts and perplexity bands."""
    judged = judge(_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "lang", "surprise", "best_quarter", "low", "high")


@_query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality; one fold's labels are held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_classifier.fit(docs, quality_classifier.training_labels(labels))
    scored = quality_classifier.score(docs, model, ["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", quality_classifier.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their expected severity of toxicity."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, quality_classifier.training_labels(labels))
    scored = toxicity.severity(docs, model, ["doc_id"]).select("row.doc_id", "severity", "p_toxic")
    return scored.select("doc_id", "severity", "p_toxic", (F.col("p_toxic") >= toxicity.TOXIC).alias("toxic"),
                         quality_classifier.held_out("doc_id").alias("held_out"))


#: Stand-in inputs from the pages table, the same text in Spark and DuckDB: when each
#: page was fetched, and dated list histories of domains and URLs seen in the table.
CAPTURES = "SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 7919) % 366 AS INT) AS fetched_at FROM pages"
HISTORY = r"""
WITH h AS (
  SELECT DISTINCT regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^(www|blog|m)[.]', '') AS pattern
  FROM pages WHERE url IS NOT NULL),
e AS (
  SELECT 'domain' AS kind, pattern, length(pattern) * 37 AS k FROM h
  UNION ALL SELECT 'url', substr(split_part(url, '#', 1), strpos(url, '://') + 3), CAST(page_id AS INT)
  FROM pages WHERE page_id % 40 = 7)
SELECT CASE WHEN k % 3 = 0 THEN 'adult' WHEN k % 3 = 1 THEN 'spam' ELSE 'optout' END AS list, kind, pattern, action,
       DATE '2024-01-01' + CAST(d AS INT) AS day
FROM (SELECT kind, pattern, k, 'add' AS action, k % 150 AS d FROM e
      UNION ALL SELECT kind, pattern, k, 'remove', k % 150 + 60 FROM e
      UNION ALL SELECT kind, pattern, k, 'add', k % 150 + 150 FROM e WHERE k % 2 = 0) AS x
"""


@_query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' captures against list entries active at fetch time."""
    pages = _table(spark, sf_dir, "pages")
    captures = spark.sql(CAPTURES.replace("pages", "{pages}"), pages=pages)
    history = spark.sql(HISTORY.replace("strpos(url", "instr(url").replace("pages", "{pages}"), pages=pages)
    judged = filter_urls(captures, history, carry=["page_id"])
    return judged.select("row.page_id", "host", "day", F.array_join("lists", ",").alias("lists"), "n_hits", "blocked")


ORACLES["op2_url_filters"] = rf"""
WITH captures AS ({CAPTURES}), history AS ({HISTORY}),
c AS (
  SELECT page_id, CAST(fetched_at AS DATE) AS day,
         rtrim(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.') AS host,
         lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1)) AS rest FROM captures),
-- an entry is active when the last action on it up to the day is "add"
st AS (
  SELECT c.page_id, h.list, h.kind, h.pattern, arg_max(h.action, (h.day, h.action = 'add')) AS last
  FROM c JOIN history h ON h.day <= c.day AND (
    (h.kind = 'domain' AND (c.host = h.pattern OR ends_with(c.host, '.' || h.pattern)))
    OR (h.kind = 'url' AND lower(h.pattern) = c.host || CASE WHEN c.rest = '' THEN '/' ELSE c.rest END))
  GROUP BY ALL),
hit AS (SELECT page_id, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n FROM st WHERE last = 'add' GROUP BY 1)
SELECT c.page_id, c.host, c.day, coalesce(lists, '') AS lists, coalesce(n, 0)::BIGINT AS n_hits, coalesce(n, 0) > 0 AS blocked
FROM c LEFT JOIN hit USING (page_id)
"""
