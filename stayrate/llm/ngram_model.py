"""A modified Kneser-Ney n-gram model, counted by Spark, in sorted hash arrays.

The units are the words of the text (``WORDS``: 32-bit hashes, and an end after the
last) or its bytes (``BYTES``); n-grams of ``order`` units pack into one integer.
Tasks count the n-grams of their texts into sorted arrays, so a hot n-gram is one row
a task, and Spark adds the counts up by language; every document and every unit is
counted, and what is gathered grows with the different n-grams of the input.  Lower
orders use continuation counts (how many different units precede an n-gram), each
order and language has the three discounts of modified Kneser-Ney, and orders are
interpolated down to a uniform distribution over bytes, or over the language's words
and an unknown one.

The finished model is the discounted counts of n-grams and the totals of contexts,
keyed by 64-bit hashes, range-partitioned and sorted by hash: one file per range in
the shared folder; only sums by key make it, no joins.  A task that scores text looks
n-grams up by binary search and interpolates.  It keeps the arrays in memory while
they are within ``CACHE_ENTRIES``; a larger model is read range by range for each
block of sorted queries, so a task's memory has a bound and the model none.

A text that was counted into the model is scored without itself: an n-gram or
context that no other text has is taken as not in the model, so unusual text does not
look usual because it has been seen once.  What occurs once in all can then never be
found, and ``fit`` leaves it out of the arrays (not out of the counts) on request.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.store import materialize, read_file, shared_uri, ship, task, write_file

#: Bits of a unit.
BYTES, WORDS = 8, 32
ORDER = 5
WORD_ORDER = 2
#: Distinct n-grams a task holds before it hands its counts on.
COUNT_ENTRIES = 2_000_000
#: Entries of one array file, about, and entries a worker keeps in memory.
FILE_ENTRIES = 1_000_000
CACHE_ENTRIES = 8_000_000
#: Discounts of at most so many languages are broadcast.
BROADCAST_LANGUAGES = 10_000
#: Stands before a text's first unit, and after a text's last word.
PAD, END = 0, 1

_WORKER: dict[str, tuple[np.ndarray, np.ndarray]] = {}


# -- n-grams of a buffer ----------------------------------------------------------
def word_units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each text, then ``END``, and offsets; an empty text has no units."""
    starts, ends, text = spans.word_spans(data, offs)
    full = np.diff(offs) > 0
    cut = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(full)) + full)]).astype(np.int64)
    out = np.full(cut[-1], END, np.uint64)
    if len(starts):
        h = spans.span_hashes(data, starts, ends) >> np.uint64(64 - WORDS)
        before = np.concatenate([[0], np.cumsum(full)])[text]
        out[np.arange(len(h)) + before] = np.maximum(h, np.uint64(END + 1))
    return out, cut


def units_of(data: np.ndarray, offs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return word_units(data, offs) if bits == WORDS else (data, offs)


def padded_keys(data: np.ndarray, offs: np.ndarray, order: int, bits: int = BYTES) -> np.ndarray:
    """The n-gram that ends at each unit, as an integer; texts start after pads."""
    n = len(data)
    start = np.repeat(offs[:-1], np.diff(offs))  # of each unit's text
    at = np.arange(n)
    key = data.astype(np.uint64)
    for k in range(1, order):
        prev = np.zeros(n, np.uint64)
        prev[k:] = data[:-k] if k < n else 0
        prev[at - k < start] = PAD
        key |= prev << np.uint64(bits * k)
    return key


def count_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def count_ngrams(docs: DataFrame, order: int = ORDER, text_col: str = "text", lang_col: str = "lang",
                 bits: int = BYTES) -> DataFrame:
    """(lang, key, count) over all units of all texts (a null language is '')."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}

        def out(lang: str) -> pa.RecordBatch:
            keys, counts = _added(held.pop(lang))
            size.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)),
                                               pa.array(counts.astype(np.int64))], names=["lang", "key", "count"])

        for batch in batches:
            names = batch.column(1).to_pylist()
            for lang in sorted(set(names)):
                texts = batch.column(0).filter(pa.array([x == lang for x in names]))
                data, offs = spans.text_buffer(texts)
                for lo, hi in spans.chunks(offs):
                    if offs[hi] == offs[lo]:
                        continue
                    units, cut = units_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], bits)
                    keys, counts = count_keys(padded_keys(units, cut, order, bits))
                    held.setdefault(lang, []).append((keys, counts))
                    size[lang] = size.get(lang, 0) + len(keys)
                    if size[lang] > COUNT_ENTRIES // 2:
                        held[lang] = [_added(held[lang])]
                        size[lang] = len(held[lang][0][0])
                        if sum(size.values()) > COUNT_ENTRIES:
                            yield out(max(size, key=size.get))
        for lang in list(held):
            yield out(lang)

    part = rows.mapInArrow(task(run), "lang string, key long, count long")
    return part.groupBy("lang", "key").agg(F.sum("count").alias("count"))


# -- the model ----------------------------------------------------------------------
@dataclass(frozen=True)
class Model:
    """Array files (first hash, last hash, entries, uri) of a fitted model."""

    order: int
    files: tuple[tuple[int, int, int, str], ...]
    bits: int = BYTES


#: Kinds of entries: discounted count of an n-gram; total and freed count of a context;
#: number of a language's words and the unknown one.
GRAM, CONTEXT, SIZE = 0, 1, 2


def _entry(kind: int, level: int, key: str | F.Column, a: F.Column, b: F.Column, seen: F.Column) -> list[F.Column]:
    return [F.xxhash64(F.lit(kind), F.lit(level), "lang", key).alias("h"), a.cast("float").alias("a"),
            b.cast("float").alias("b"), seen.cast("long").alias("seen")]


def estimate(counts: DataFrame, order: int = ORDER, bits: int = BYTES, singles: bool = True) -> DataFrame:
    """(h, a, b, seen): the entries of all orders; ``singles``: also of what occurs once."""
    zero, entries = F.lit(0), []
    levels = {order: materialize(counts.withColumn("seen", F.col("count")), "ngrams")}
    for n in range(order - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << bits * n) - 1)).alias("key")
        levels[n] = materialize(levels[n + 1].groupBy("lang", shorter)
                                .agg(F.count(F.lit(1)).alias("count"), F.sum("seen").alias("seen")), f"order{n}")
    for n, rows in levels.items():
        of = lambda k: F.sum(F.when(F.col("count") == k, 1).otherwise(0))
        d = rows.groupBy("lang").agg(*[of(k).alias(f"t{k}") for k in (1, 2, 3, 4)])
        y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
        discount = [F.when((F.col(f"t{k}") > 0), F.greatest(k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}"), F.lit(0.1)))
                    for k in (1, 2, 3)]
        d = d.select(F.col("lang").alias("dl"), *[F.coalesce(x, F.lit(0.5 * k)).alias(f"d{k}")
                                                  for k, x in zip((1, 2, 3), discount)])
        cut = F.when(F.col("count") == 1, F.col("d1")).when(F.col("count") == 2, F.col("d2")).otherwise(F.col("d3"))
        d = materialize(d, "discounts")
        few = d.count() <= BROADCAST_LANGUAGES
        rows = rows.join(F.broadcast(d) if few else d, F.col("lang") == F.col("dl")).withColumn("cut", cut)
        # A partial sum a task and context: a hot context is no task's own.
        context = (rows.groupBy("lang", F.shiftrightunsigned("key", bits).alias("context"))
                   .agg(F.sum("count").alias("total"), F.sum("cut").alias("freed"), F.sum("seen").alias("seen")))
        more = F.lit(True) if singles else F.col("seen") > 1
        entries.append(rows.where(more).select(_entry(GRAM, n, "key", F.col("count") - F.col("cut"), zero, F.col("seen"))))
        entries.append(context.where(more).select(_entry(CONTEXT, n, "context", F.col("total"), F.col("freed"), F.col("seen"))))
    if bits == WORDS:
        size = levels[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("n"))
        entries.append(size.select(_entry(SIZE, 0, zero.cast("long"), F.col("n"), zero, zero)))
    out = entries[0]
    for e in entries[1:]:
        out = out.union(e)
    return out


def fit(docs: DataFrame, order: int = ORDER, text_col: str = "text", lang_col: str = "lang", bits: int = BYTES,
        singles: bool = True) -> Model:
    """Count, estimate and store a model of all documents."""
    spark = docs.sparkSession
    entries = materialize(estimate(count_ngrams(docs, order, text_col, lang_col, bits), order, bits, singles), "entries")
    n, path = entries.count(), shared_uri(spark, "hash-arrays")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        got = [tuple(c.to_numpy() for c in b.columns) for b in batches]
        if not got:
            return
        h, a, b, seen = (np.concatenate(x) for x in zip(*got))
        uri = f"{path}/part-{part:06d}.harr"
        write_file(uri, np.array([len(h)], np.int64).tobytes(), h.tobytes(), a.astype(np.float32).tobytes(),
                   b.astype(np.float32).tobytes(), np.minimum(seen, 2**32 - 1).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
            (int(h[0]), pa.int64()), (int(h[-1]), pa.int64()), (len(h), pa.int64()), (uri, pa.string()))],
            names=["lo", "hi", "n", "uri"])

    files = max(1, -(-n // FILE_ENTRIES))
    manifest = (entries.repartitionByRange(files, "h").sortWithinPartitions("h")
                .mapInArrow(task(write), "lo long, hi long, n long, uri string"))
    rows = materialize(manifest, "hash-array-files").orderBy("lo").collect()  # a row per million entries
    return Model(order, tuple((r["lo"], r["hi"], r["n"], r["uri"]) for r in rows), bits)


# -- looking up -----------------------------------------------------------------------
#: Of an array file: hashes, two values, counts.
_COLUMNS = (np.int64, np.float32, np.float32, np.uint32)


def _arrays(uri: str) -> tuple[np.ndarray, ...]:
    buf = read_file(uri)
    n = int(np.frombuffer(buf, np.int64, 1)[0])
    return (np.frombuffer(buf, np.int64, n, 8), np.frombuffer(buf, np.float32, n, 8 + 8 * n),
            np.frombuffer(buf, np.float32, n, 8 + 12 * n), np.frombuffer(buf, np.uint32, n, 8 + 16 * n))


class Scorer:
    """Log probabilities of units under a model, in a task."""

    def __init__(self, model: Model):
        self.model = model
        self.small = sum(f[2] for f in model.files) <= CACHE_ENTRIES

    def _files(self) -> Iterator[tuple[np.ndarray, ...]]:
        if not self.small:
            for _, _, _, uri in self.model.files:
                yield _arrays(uri)
        elif self.model.files:
            key = self.model.files[0][3]
            if key not in _WORKER:
                _WORKER.clear()
                whole = tuple(np.empty(sum(f[2] for f in self.model.files), t) for t in _COLUMNS)
                at = 0
                for _, _, n, uri in self.model.files:  # one file beside the whole
                    for x, part in zip(whole, _arrays(uri)):
                        x[at:at + n] = part
                    at += n
                _WORKER[key] = whole
            yield _WORKER[key]

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both values (NaN where the model has none) and counts of sorted hashes."""
        out = np.full(len(h), np.nan, np.float32), np.full(len(h), np.nan, np.float32), np.zeros(len(h), np.uint32)
        for keys, *columns in self._files():
            lo, hi = np.searchsorted(h, keys[0]), np.searchsorted(h, keys[-1], "right")
            at = np.searchsorted(keys, h[lo:hi])
            hit = keys[at] == h[lo:hi]
            for o, c in zip(out, columns):
                o[lo:hi][hit] = c[at[hit]]
        return out

    def _found(self, wanted: list[tuple[int, int, str, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
        """Entries of each (kind, level, language, keys), all looked up in one pass over the files."""
        uniq = [(u, inverse.astype(np.int32)) for u, inverse in (np.unique(x[3], return_inverse=True) for x in wanted)]
        h = np.concatenate([spark_hash(kind, level, lang, u) for (kind, level, lang, _), (u, _) in zip(wanted, uniq)])
        order = np.argsort(h)
        got = []
        for x in self.look_up(h[order]):
            back = np.empty_like(x)
            back[order] = x
            got.append(back)
        at = 0
        for u, inverse in uniq:
            yield tuple(x[at:at + len(u)][inverse] for x in got)
            at += len(u)

    def log_probs(self, lang: str, keys: np.ndarray, own=None) -> np.ndarray:
        """Log probability of the last unit of each n-gram given the units before it.

        ``own(key)``: how often each n-gram's text has the key made of it, if the text is
        one of those counted.
        """
        return self.all_log_probs([(lang, keys, own)])[0]

    def all_log_probs(self, parts: list[tuple]) -> list[np.ndarray]:
        """``log_probs`` of several languages' n-grams."""
        bits, wanted = self.model.bits, []
        levels = range(1, self.model.order + 1)
        for lang, keys, _ in parts:
            wanted.append((SIZE, 0, lang, np.zeros(1, np.uint64)))
            for n in levels:
                k = keys & np.uint64((1 << bits * n) - 1)
                wanted += [(GRAM, n, lang, k), (CONTEXT, n, lang, self._context(k))]
        found, out = self._found(wanted), []
        for _, keys, own in parts:
            size = next(found)[0][0]
            p = np.full(len(keys), 1 / 256 if np.isnan(size) else 1 / float(size))
            for n in levels:
                k = keys & np.uint64((1 << bits * n) - 1)
                (count, _, seen), (total, freed, all_seen) = next(found), next(found)
                hit, known = ~np.isnan(count), ~np.isnan(total)
                if own is not None:
                    hit &= seen > own(k)
                    known &= all_seen > own(self._context(k))
                q = (np.where(hit, count, 0) + freed.astype(float) * p) / total
                p = np.where(known, q, p)
            out.append(np.log(p))
        return out

    def _context(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(self.model.bits)

    def unit_scores(self, data: np.ndarray, offs: np.ndarray, langs: list[str]) -> np.ndarray:
        """Log probability of each unit of the texts, each text without itself."""
        text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
        keys = padded_keys(data, offs, self.model.order, self.model.bits)
        _, at, inverse, count = np.unique(_of_text(keys, text), return_index=True, return_inverse=True, return_counts=True)
        text, keys = text[at], keys[at]
        code = {x: k for k, x in enumerate(dict.fromkeys(langs))}
        which = np.array([code[x] for x in langs], np.int64)
        parts, rows = [], []
        for lang, c in code.items():
            at = np.flatnonzero(which[text] == c)
            if len(at):
                def own(key: np.ndarray, n=count[at], t=text[at]) -> np.ndarray:
                    _, inverse = np.unique(_of_text(key, t), return_inverse=True)
                    return np.bincount(inverse, n)[inverse]

                parts.append((lang, keys[at], own))
                rows.append(at)
        logs = np.empty(len(keys))
        for at, x in zip(rows, self.all_log_probs(parts) if parts else []):
            logs[at] = x
        return logs[inverse]

    def text_scores(self, data: np.ndarray, offs: np.ndarray, langs: list[str]) -> np.ndarray:
        """Mean log probability per unit of each text without itself (NaN for an empty one)."""
        return text_means(self.unit_scores(data, offs, langs), offs)


def text_means(x: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Mean of each text's units (NaN for an empty one)."""
    size = np.diff(offs)
    total = np.bincount(np.repeat(np.arange(len(size)), size), x, len(size))
    return np.divide(total, size, out=np.full(len(size), np.nan), where=size > 0)


def _of_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A hash of each key in its text."""
    return spans.mix64(spans.mix64(keys) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def spark_hash(kind: int, level: int, lang: str, keys: np.ndarray) -> np.ndarray:
    """Spark's xxhash64(kind, level, lang, key): each value hashed with the last hash as seed."""
    import xxhash

    seed = 42
    for v in (kind, level):
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(4, "little"), seed)
    seed = xxhash.xxh64_intdigest(lang.encode(), seed)
    return _xxh64_long(keys, seed).view(np.int64)


def _xxh64_long(x: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of 8-byte integers."""
    p1, p2, p3, p4, p5 = (np.uint64(v) for v in (  # the hash's fixed primes
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda v, r: (v << np.uint64(r)) | (v >> np.uint64(64 - r))
    h = np.full(len(x), (seed + int(p5) + 8) % (1 << 64), np.uint64)
    h ^= rot(x * p2, 31) * p1
    h = rot(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))
