"""Spelling variants by permuterm rotations: words one inserted, deleted or replaced code point apart.

Words are counted in tasks over whole texts and added up by Spark.  Every word is
marked with an end ``$`` and rotated.  Take a word ``a x b`` with the code point ``x``
skipped: the rotation that starts behind it is ``b $ a x``, so all words that differ
from it in that place share the prefix ``b $ a``, and the word ``a b`` without it has
``b $ a`` as a whole rotation.  So each word gives one entry per skipped code point
and one per whole rotation; the entries are range-partitioned and sorted by that
prefix, and one scan of the sorted groups sees all neighbours.  In a run of equal code
points every deletion gives the same word; only the first meets the whole rotation.

A group holds one word per code point of the alphabet at most, besides the one whole
rotation, so none is hot.  Words go by ids
in code-point order.  Pairs are never listed: a word's neighbours in a group are
its size without the word, and the commonest of them is the group's first or second.

Forms point at words at least twice as common, so chains of forms are short; roots are
found by doubling the pointers, one stored table a round.

Defined results: a null text has no words; a null id is the empty string in the
checksum; repeated rows count again; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.store import materialize, ship, task

#: One run in so many loses a code point (see ``spoil``).
SPOILT = 97
#: Different words that a task holds before it hands its counts on, and rows it hands on at a time.
HELD_WORDS = 300_000
OUT_ROWS = 20_000
#: Runs of more bytes are checksummed one by one.
LONG_RUN = 64
#: Bytes of different words that a task holds.
HELD_BYTES = 32 << 20
#: Longer prefixes of rotations stand as hashes: three primes and a base for each.
LITERAL = 64
_FIELDS = ((2147483647, 911382323), (2147483629, 972663749), (2147483587, 756839401))

_LETTER = spans.byte_set(range(0x41, 0x5B), range(0x61, 0x7B))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)  # the reflected CRC-32 polynomial
    return t


_CRC = _crc_table()


def runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text) of the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``: U+00C0 to U+00FF
    are the byte C3 and one more."""
    lead = data == 0xC3
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return spans.word_spans(inside.astype(np.uint8), offs, spans.byte_set(0))


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of each run's bytes, going on from the checksum ``before``."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, left = starts[order], size[order]
    crc = before[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    long = int(np.searchsorted(-left, -LONG_RUN))
    for k in range(int(left[long]) if long < len(left) else 0):
        hi = int(np.searchsorted(-left, -k))
        s = crc[long:hi]
        crc[long:hi] = _CRC[(s ^ data[at[long:hi] + k]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(long):
        crc[k] = zlib.crc32(data[at[k]:at[k] + left[k]].tobytes(), int(before[order[k]]))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def spoil(word: str, checksum: int) -> str:
    """The run without its code point ``checksum % length``."""
    k = checksum % len(word)
    return word[:k] + word[k + 1:]


def buffer_words(data: np.ndarray, offs: np.ndarray, ids: list, least: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) over the texts of a buffer; words of ``least`` code points or more."""
    data = _LOWER[data]
    starts, ends, text = runs(data, offs)
    leads = np.concatenate([[0], np.cumsum(data == 0xC3, dtype=np.int64)])
    points = (ends - starts) - (leads[ends] - leads[starts])
    long = points >= least
    starts, ends, text, points = starts[long], ends[long], text[long], points[long]
    if not len(starts):
        return
    before = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in ids], np.uint32)
    crc = run_checksums(data, starts, ends, before[text])
    hit = crc % SPOILT == 0
    raw = data.tobytes()
    for s, e, c, n in zip(starts[hit].tolist(), ends[hit].tolist(), crc[hit].tolist(), points[hit].tolist()):
        if n > least:
            yield spoil(raw[s:e].decode(), c), 1
    starts, ends = starts[~hit], ends[~hit]
    _, first, n = np.unique(spans.span_hashes(data, starts, ends), return_index=True, return_counts=True)
    for s, e, k in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
        yield raw[s:e].decode(), k


def count_words(docs: DataFrame, least: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all texts."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            words = list(held)
            for lo in range(0, len(words), OUT_ROWS):
                part = words[lo:lo + OUT_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([held[w] for w in part], pa.int64())],
                                                 names=["word", "n"])
            held.clear()

        for batch in batches:
            data, offs = spans.text_buffer(batch.column(1))
            ids = batch.column(0).to_pylist()
            for lo, hi in spans.chunks(offs):
                for word, n in buffer_words(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], ids[lo:hi], least):
                    had = held.get(word, 0)
                    held[word] = had + n
                    size += 0 if had else len(word)
                if len(held) > HELD_WORDS or size > HELD_BYTES:
                    yield from out()
                    size = 0
        yield from out()

    return rows.mapInArrow(task(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(key, whole, first, id, n): every rotation of the marked words, whole or less its last,
    skipped code point; ``first``: the skipped one differs from the one before it.

    Prefixes of more than ``LITERAL`` code points stand as hashes, so that a very long
    word gives entries in proportion to its length.
    """
    at = F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("i")
    short, long = F.char_length("word") <= LITERAL, F.char_length("word") >= LITERAL
    each = words.where(short).select("id", "word", "n", at)
    turned = lambda skip: F.concat(F.expr(f"substring(word, i + {1 + skip})"), F.lit("$"), F.expr("substring(word, 1, i)"))
    whole = (each.where(F.char_length("word") < LITERAL)
             .select(turned(0).alias("key"), F.lit(True).alias("whole"), F.lit(True).alias("first"), "id", "n"))
    first = F.expr("i = 0 OR substring(word, i, 1) <> substring(word, i + 1, 1)")
    cut = each.where(F.col("i") < F.char_length("word")).select(turned(1).alias("key"), F.lit(False), first, "id", "n")
    hashed = words.where(long).select("id", "n", "word").mapInArrow(
        task(_hashed_rotations(LITERAL)), "key string, whole boolean, first boolean, id long, n long")
    return whole.union(cut).union(hashed)


def _powers(base: int, p: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), p)) % np.uint64(p)])
    return out[:n]


def rotation_hashes(points: np.ndarray, skip: int) -> list[str]:
    """A hash of ``b $ a`` for every split of the code points into a, ``skip`` skipped ones and b."""
    n = len(points)
    cut = np.arange(n + 1 - skip)
    parts = []
    for p, base in _FIELDS:
        m = np.uint64(p)
        up, down = _powers(base, p, n + 2), _powers(pow(base, -1, p), p, n + 2)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points.astype(np.uint64) * up[:n] % m) % m])
        b = (total[n] + m - total[cut + skip]) % m * down[cut + skip] % m
        behind = n - skip - cut  # code points of b
        parts.append((b + up[behind] * np.uint64(ord("$")) % m + total[cut] * up[behind + 1] % m) % m)
    return [f"#{n - skip + 1}:{x:x}:{y:x}:{z:x}" for x, y, z in zip(*(q.tolist() for q in parts))]


def _hashed_rotations(literal: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n, word in zip(*(c.to_pylist() for c in batch.columns)):
                points = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                first = np.concatenate([[True], points[1:] != points[:-1]])
                for skip, flags in ((0, np.ones(len(points) + 1, bool)), (1, first)):
                    if len(points) - skip + 1 <= literal:
                        continue
                    keys = rotation_hashes(points, skip)
                    for lo in range(0, len(keys), OUT_ROWS):
                        part = keys[lo:lo + OUT_ROWS]
                        k = len(part)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(part), pa.array(np.full(k, skip == 0)), pa.array(flags[lo:lo + k]),
                             pa.array(np.full(k, i, np.int64)), pa.array(np.full(k, n, np.int64))],
                            names=["key", "whole", "first", "id", "n"])
    return run


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best) with best = (-n, id) of the commonest near word, for words that have one."""
    n_parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_keys = rotations(words).repartitionByRange(n_parts, "key")
    group, peers = Window.partitionBy("key"), Window.partitionBy("key", "whole")
    ranked = peers.orderBy("me")
    longer = ~F.col("whole") & F.col("first")
    rows = (sorted_keys.withColumn("me", F.struct((-F.col("n")).alias("m"), F.col("id").alias("w")))
            .withColumn("at", F.row_number().over(ranked)).withColumn("next", F.lead("me").over(ranked))
            .withColumn("top", F.min("me").over(peers)).withColumn("peers", F.count(F.lit(1)).over(peers) - 1)
            .withColumn("base", F.min(F.when(F.col("whole"), F.col("me"))).over(group))
            .withColumn("longer", F.count(F.when(longer, 1)).over(group))
            .withColumn("top_longer", F.min(F.when(longer, F.col("me"))).over(group)))
    # Words of one length differ in the skipped place; the whole rotation is the word without it.
    other = F.when(F.col("at") == 1, F.col("next")).otherwise(F.col("top"))
    shorter = F.when(F.col("first"), F.col("base"))
    near = F.when(F.col("whole"), F.col("longer")).otherwise(F.col("peers") + shorter.isNotNull().cast("long"))
    best = F.when(F.col("whole"), F.col("top_longer")).otherwise(F.least(other, shorter))
    return (rows.select("id", near.alias("near"), best.alias("best")).where("near > 0")
            .groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): the last one that the forms lead to."""
    at = materialize(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        up = at.select(F.col("id").alias("of"), F.col("root").alias("higher"))
        step = at.join(up, F.col("root") == F.col("of"), "left")
        step = materialize(step.select("id", F.coalesce("higher", "root").alias("root"),
                                       F.col("higher").isNotNull().alias("moved")), "roots")
        at = step.select("id", "root")
        if step.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, least: int = 5, min_count: int = 3, ratio: int = 2, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``least`` code points and ``min_count`` occurrences."""
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = materialize(count_words(docs, least, id_col, text_col).where(F.col("n") >= min_count), "counts")
    # Ids in code-point order: range partitions are in order, and so are the ids of partitions.
    ordered = counted.repartitionByRange(n_parts, "word").sortWithinPartitions("word")
    words = materialize(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = neighbours(words.select("id", "word", "n")).withColumnRenamed("id", "of")
    joined = words.select("id", "n").join(near, F.col("id") == F.col("of"), "left")
    larger = -F.col("best.m") >= ratio * F.col("n")
    formed = materialize(joined.select("id", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                       F.when(larger, F.col("best.w")).alias("form"),
                                       F.when(larger, -F.col("best.m")).alias("form_n")), "forms")
    last = roots(formed.where("form IS NOT NULL").select("id", "form")).select(F.col("id").alias("last_of"), "root")
    named = lambda as_id, as_name: words.select(F.col("id").alias(as_id), F.col("word").alias(as_name))
    linked = (formed.where("form IS NOT NULL").join(last, F.col("id") == F.col("last_of"))
              .join(named("f", "form_word"), F.col("form") == F.col("f")).join(named("r", "root_word"), F.col("root") == F.col("r"))
              .select(F.col("id").alias("of"), "form_word", "root_word", F.col("form_n").alias("larger_n")))
    plain = formed.select("id", "n_near").withColumnRenamed("id", "near_of")
    return (words.join(plain, F.col("id") == F.col("near_of")).join(linked, F.col("id") == F.col("of"), "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
                    F.col("larger_n").alias("form_n")))
