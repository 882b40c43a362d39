"""Quality rules: text counts and bands of n-gram perplexity by language.

A document must have enough words and not repeat itself, and its perplexity
under the corpus's own modified Kneser-Ney model must lie in its language's
band: from ``BELOW`` to ``ABOVE`` robust standard deviations around the median of
the log perplexities of the documents that pass the counts.  Text that is too
predictable is as suspect as noise.  The deviation is that of the upper half (from
the median and the upper quartile), as copies, which are not this operator's to
remove, pull the lower quartile down.

Good text may quote a passage in another language.  So a document above the band
is kept if its best quarter is not: the lower quartile of the log perplexities of
its windows of ``WINDOW`` words.  Noise and text in the wrong language are above it
throughout.

Defined results: a null or empty text has no words and fails; a null language
is a language of its own; a null id is kept as it is; repeated rows are
documents of their own; other columns are ignored or carried as they are; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from stayrate.llm import ngram_model, spans, word_model
from stayrate.llm.store import materialize

BELOW, ABOVE = 14.0, 2.5
#: The least deviation (in log perplexity per word), for languages whose texts are all alike.
LEAST_SPREAD = 0.2
#: Words (and ends) of a window that stands for a part of a document.
WINDOW = 20
#: Resolution of the quartiles.
STEP = 0.001
_SYMBOLS = spans.byte_set(*map(ord, "#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(data: np.ndarray, offs: np.ndarray, words: tuple | None = None) -> dict[str, np.ndarray]:
    """The counts of each text of a buffer (``words``: its ``hashed_words``, if they are known)."""
    n = len(offs) - 1
    starts, ends, text, h = words or word_model.hashed_words(data, offs)
    gap = spans.SPACE[data] if len(data) else np.empty(0, bool)
    lead = (data & 0xC0) != 0x80  # first bytes of code points
    out = {"n_words": np.bincount(text, minlength=n), "word_chars": spans.per_text(lead & ~gap, offs),
           "n_symbols": spans.per_text(_SYMBOLS[data] if len(data) else gap, offs)}
    # Words in 3-word windows that the text has twice or more.
    window, first = spans.window_hashes(h, text, 3)
    twice = _twice(window, text[first])
    cover = np.zeros(len(starts) + 1, np.int64)
    for k in (first[twice],):
        np.add.at(cover, k, 1)
        np.add.at(cover, np.minimum(k + 3, len(starts)), -1)
    again = np.cumsum(cover[:-1]) > 0
    out["n_repeat_words"] = np.bincount(text[again], minlength=n)
    # Lines with a word that equal an earlier one.
    feeds = np.flatnonzero(data == 0x0A)
    a = np.sort(np.concatenate([offs[:-1], feeds + 1]))
    b = np.sort(np.concatenate([offs[1:], feeds]))
    words = np.concatenate([[0], np.cumsum(~gap, dtype=np.int64)])
    full = words[b] > words[a]
    a, b = a[full], b[full]
    line_text = np.searchsorted(offs, a, "right") - 1
    key = spans.mix64((spans.span_hashes(data, a, b) if len(a) else np.empty(0, np.uint64))
                      + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, at = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(line_text, minlength=n) - np.bincount(line_text[at], minlength=n)
    return out


def _twice(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which hashes their text has twice or more."""
    key = spans.mix64(h + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[inverse] > 1 if len(key) else np.empty(0, bool)


def best_quarter(surprise: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Lower quartile of the means of each text's windows (NaN for an empty one)."""
    size = np.diff(offs)
    windows = -(-size // WINDOW)
    first = np.concatenate([[0], np.cumsum(windows)])
    at = np.arange(len(surprise)) - np.repeat(offs[:-1], size)
    which = np.repeat(first[:-1], size) + at // WINDOW
    mean = np.bincount(which, surprise, first[-1]) / np.bincount(which, minlength=first[-1])
    mean = mean[np.lexsort((mean, np.repeat(np.arange(len(size)), windows)))]
    out = np.full(len(size), np.nan)
    full = size > 0
    out[full] = mean[(first[:-1] + (windows - 1) // 4)[full]]
    return out


def measure(docs: DataFrame, carry: list[str], min_words: int = 50, repeat_percent: int = 50,
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``row`` (a struct of the carried columns), the counts, base_failed, lang, log perplexity
    per word (and end) and that of the best quarter of every document, stored."""
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))

    def prepare(row: pa.Array, langs: list[str], data: np.ndarray, offs: np.ndarray, words: tuple) -> pa.RecordBatch:
        c = text_counts(data, offs, words)
        failed = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > repeat_percent * c["n_words"])
        return pa.RecordBatch.from_arrays([row, *(pa.array(c[x].astype(np.int64)) for x in _COUNTS), pa.array(failed), pa.array(langs, pa.string())],
                                          names=["row", *_COUNTS, "base_failed", "lang"])

    def finish(docs: pa.RecordBatch, surprise: np.ndarray, offs: np.ndarray) -> Iterator[pa.RecordBatch]:
        score, best = ngram_model.text_means(surprise, offs), best_quarter(surprise, offs)
        yield pa.RecordBatch.from_arrays([*docs.columns, pa.array(score, mask=np.isnan(score)), pa.array(best, mask=np.isnan(best))],
                                         names=[*docs.schema.names, "surprise", "best_quarter"])

    schema = StructType([rows.schema["row"], *(StructField(x, LongType()) for x in _COUNTS),
                         StructField("base_failed", BooleanType()), StructField("lang", StringType()),
                         StructField("surprise", DoubleType()), StructField("best_quarter", DoubleType())])
    # Tasks hold the carried columns of a chunk: a quarter of the words where these are the texts themselves.
    chunk = word_model.CHUNK_WORDS // (4 if text_col in carry else 1)
    return word_model.score_texts(rows, prepare, finish, schema, "measured", chunk_words=max(1, chunk))


def bands(measured: DataFrame, below: float = BELOW, above: float = ABOVE) -> DataFrame:
    """(band_lang, low, high) of log perplexity, from each language's quartiles.

    The quartiles are read from a histogram of steps of ``STEP``, so they do not
    depend on the order of rows and no language is gathered into one task.
    """
    steps = (measured.where("NOT base_failed").groupBy("lang", F.floor(F.col("surprise") / STEP).alias("step"))
             .agg(F.count(F.lit(1)).alias("n")))
    up = Window.partitionBy("lang").orderBy("step")
    whole = Window.partitionBy("lang")
    steps = steps.withColumn("below", F.sum("n").over(up)).withColumn("total", F.sum("n").over(whole))
    q = [F.min(F.when(F.col("below") >= F.col("total") * x, F.col("step"))) * STEP for x in (0.5, 0.75)]
    out = steps.groupBy("lang").agg(*[c.alias(f"q{k}") for k, c in enumerate(q)])
    spread = F.greatest((F.col("q1") - F.col("q0")) / 0.6745, F.lit(LEAST_SPREAD))
    return out.select(F.col("lang").alias("band_lang"), (F.col("q0") - below * spread).alias("low"),
                      (F.col("q0") + above * spread).alias("high"))


def judge(docs: DataFrame, carry: list[str], below: float = BELOW, above: float = ABOVE, **rules) -> DataFrame:
    """``measure`` with the verdict ``kept``."""
    measured = measure(docs, carry, **rules)
    limits = materialize(bands(measured, below, above), "bands")
    # A row per language: broadcast while they are few, else a join that AQE splits.
    limits = F.broadcast(limits) if limits.count() <= ngram_model.BROADCAST_LANGUAGES else limits
    judged = measured.join(limits, F.col("lang") == F.col("band_lang"), "left")
    inside = F.coalesce((F.col("surprise") >= F.col("low")) & (F.least("surprise", "best_quarter") <= F.col("high")), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)
