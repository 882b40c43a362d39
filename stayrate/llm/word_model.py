"""Word bigrams of a corpus under modified Kneser-Ney, counted and looked up by range.

A task cuts its texts into chunks of about ``CHUNK_WORDS`` words and sends each chunk's
different bigrams, with their counts, to the range of words that holds them, as sorted,
delta-coded and compressed blocks.  The task of a range adds the counts up into
sorted arrays, stores them as one file of hashes and counts, and answers every chunk in the order of its
block, by the same arrays.  Continuation counts and contexts are added up and answered by
word range in a second step, where a chunk's words are those that begin its bigrams, a third one puts each chunk's answers into one file, and the texts are read
again, chunk by chunk with its file, and scored:

    p2(w | v) = (c(vw) - D2(c(vw)) + F2(v) p1(w)) / c(v)
    p1(w)     = (n(w) - D1(n(w)) + F1 / size) / n

with c counts, n(w) the different words before w, D the three discounts of each order and language,
F what they free and size the language's words and an unknown one.  So each task holds a range
or a chunk, a chunk reads its own answers only, and all work grows in proportion to the text.

A chunk is named by what it holds.  Both readings deal the texts alike: they scan the same files with the
same splits (``spark.sql.files.minPartitionNum`` is held meanwhile; input that is more than a scan of files is
stored first), and a chunk without answers stops the job.

A text is scored without itself: a bigram, word or context that no other text has counts as not in the
model.  What occurs once in all can thus never be found, and the array files leave it out (no count does).

The commonest words of a bounded sample have short codes, so that blocks are small, all others are their
hash of 56 bits.  The sample decides nothing but the size of blocks and how contexts are dealt:
a common context is split over several ranges.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.store import discard, materialize, read_file, shared_uri, ship, task, write_file

#: Words of a chunk, about.
CHUNK_WORDS = 3_000_000
#: Text of the sample that short codes come from, and short codes at most.
SAMPLE_BYTES = 48 << 20
SAMPLE_TEXT = 1 << 20
COMMON = 1 << 19
#: Bigrams of a range that the number of ranges aims at, ranges of a shuffle partition at most, bytes of a word, about.
RANGE_GRAMS = 1_200_000
RANGES_PER_TASK = 64
WORD_BYTES = 6
#: Entries of sums by word that a task holds.
HELD_STATS = 2_000_000
#: Languages whose discounts are broadcast at most.
BROADCAST_LANGUAGES = 10_000
#: Codes: before a text, after it, common words from 2 on, and the bit above the hashes of all others:
#: of 10^9 different words some seven pairs share one.
PAD, END, FIRST, RARE = 0, 1, 2, np.uint64(1 << 56)
#: Kinds of rows.
GRAMS, WORDS, GRAM_ANSWER, SUMS, LEVEL, WORD_ANSWER = range(6)
_ROW = "kind int, lang string, part int, chunk long, blob binary, t array<long>"


# -- blocks ---------------------------------------------------------------------------------
def pack(a: np.ndarray) -> bytes:
    """An array as compressed planes of its bytes."""
    raw = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes, kind: type) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    raw = np.frombuffer(pa.decompress(b[8:], n, codec="zstd", asbytes=True), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind) if n else np.empty(0, kind)


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _split(b: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at:at + 8], "little")
        out.append(b[at + 8:at + 8 + n])
        at += 8 + n
    return out


def _deltas(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=np.uint64(0))


def pack_grams(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted pairs with counts: first words as differences, second ones as differences behind the same first."""
    step = _deltas(a)
    first = np.concatenate([[True], step[1:] != 0]) if len(a) else np.empty(0, bool)
    return _join(pack(step), pack(np.where(first, b, _deltas(b))), pack(n.astype(np.uint32)))


def unpack_grams(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    step, d, n = (unpack(p, t) for p, t in zip(_split(blob), (np.uint64, np.uint64, np.uint32)))
    total = np.cumsum(d, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate([[True], step[1:] != 0])) if len(step) else np.empty(0, np.int64)
    before = total[first] - d[first]
    return np.cumsum(step, dtype=np.uint64), total - np.repeat(before, np.diff(np.append(first, len(step)))), n


def pack_words(codes: np.ndarray, *columns: np.ndarray) -> bytes:
    return _join(pack(_deltas(codes)), *map(pack, columns))


def unpack_words(blob: bytes, *kinds: type) -> list[np.ndarray]:
    step, *rest = _split(blob)
    return [np.cumsum(unpack(step, np.uint64), dtype=np.uint64), *(unpack(p, t) for p, t in zip(rest, kinds))]


# -- codes -----------------------------------------------------------------------------------
@dataclass(frozen=True)
class Codes:
    """Short codes of common words (by sorted hash), and how bigrams and words are dealt to ranges."""

    hashes: np.ndarray
    ranks: np.ndarray
    splits: np.ndarray  # ranges of a common context, by code
    gram_parts: int
    word_parts: int
    chunk_words: int

    def of(self, h: np.ndarray) -> np.ndarray:
        out = h >> np.uint64(8) | RARE
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            out[hit] = self.ranks[at[hit]]
        return out

    def gram_part(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        split = self.splits[np.minimum(a, np.uint64(len(self.splits) - 1)).astype(np.int64)]
        split = np.where(a < np.uint64(len(self.splits)), split, 1).astype(np.uint64)
        sub = spans.mix64(b + np.uint64(0x9E3779B97F4A7C15)) % split
        return (spans.mix64(a * np.uint64(0xD6E8FEB86659FD93) + sub) % np.uint64(self.gram_parts)).astype(np.int64)

    def word_part(self, w: np.ndarray) -> np.ndarray:
        """One for all contexts of a range but the split ones."""
        home = spans.mix64(w * np.uint64(0xD6E8FEB86659FD93)) % np.uint64(self.gram_parts)
        return (home % np.uint64(self.word_parts)).astype(np.int64)


def fit_codes(docs: DataFrame, text_col: str, chunk_words: int) -> Codes:
    """Codes from a sample of about ``SAMPLE_BYTES``; ranges from the size of all texts."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("text").alias("n")).first()
    total = size["bytes"] or 0
    share = max(1, -(-total // SAMPLE_BYTES))
    sample = texts.where((F.octet_length("text") <= SAMPLE_TEXT) & (F.pmod(F.xxhash64("text"), F.lit(share)) == 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(0))
            for lo, hi in spans.chunks(offs):
                d = data[offs[lo]:offs[hi]]
                starts, ends, _ = spans.word_spans(d, offs[lo:hi + 1] - offs[lo])
                h, n = np.unique(spans.span_hashes(d, starts, ends) if len(starts) else np.empty(0, np.uint64), return_counts=True)
                for k in range(0, len(h), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(h[k:k + 20_000].view(np.int64)), pa.array(n[k:k + 20_000])], names=["h", "n"])

    rows = (sample.mapInArrow(task(count), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "h").limit(COMMON).toArrow())
    h = rows.column("h").to_numpy().view(np.uint64) if rows.num_rows else np.empty(0, np.uint64)
    n = rows.column("n").to_numpy() if rows.num_rows else np.empty(0, np.int64)
    grams = max(1, min(RANGES_PER_TASK * n_parts, -(-total // (WORD_BYTES * RANGE_GRAMS))))
    seen = np.concatenate([[size["n"] / max(share, 1), 0], n])
    splits = np.ceil(4 * grams * seen / max(seen.sum(), 1)).clip(1).astype(np.int64)
    order = np.argsort(h)
    return Codes(h[order], (order + FIRST).astype(np.uint64), splits, grams, max(1, grams // 8), chunk_words)


# -- chunks ----------------------------------------------------------------------------------
class Chunk:
    """Texts as indexes into their sorted words."""

    def __init__(self, codes: np.ndarray, index: np.ndarray, offs: np.ndarray, full: np.ndarray, langs: list[str]):
        self.codes, self.langs = codes, langs  # codes: PAD, END, then the words
        size = np.diff(offs) + full
        self.offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        self.text = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.units = np.full(self.offs[-1], END, np.int32)
        self.units[np.arange(len(index)) + np.repeat(np.cumsum(full) - full, np.diff(offs))] = index
        self.before = np.concatenate([np.full(1, PAD, np.int32), self.units[:-1]])[:len(self.units)]
        self.before[self.offs[:-1][full > 0]] = PAD
        self.which = {x: k for k, x in enumerate(dict.fromkeys(langs))}
        self.lang = np.array([self.which[x] for x in langs], np.int64)

    def grams(self, lang: str, inverse: bool = False):
        """(places, first, second, counts[, inverse]) of a language's different bigrams, by their codes."""
        at = np.flatnonzero(self.lang[self.text] == self.which[lang])
        n = len(self.codes)
        key, *rest = np.unique(self.before[at].astype(np.int64) * n + self.units[at], return_inverse=inverse, return_counts=True)
        return (at, key // n, key % n, rest[-1], *rest[:-1])


def in_parts(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, its places in order)."""
    order = np.argsort(part, kind="stable")
    edge = np.flatnonzero(np.diff(part[order], prepend=-1))
    for lo, hi in zip(edge, np.append(edge[1:], len(order))):
        yield int(part[order[lo]]), order[lo:hi]


def _rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, lang, part, chunk, blob, t) in batches of a few MB."""
    lo = 0
    while lo < len(rows):
        hi, size = lo, 0
        while hi < len(rows) and size < 4 << 20 and hi - lo < 2_000:
            size += len(rows[hi][4])
            hi += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows[lo:hi]), (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())))],
            names=["kind", "lang", "part", "chunk", "blob", "t"])
        lo = hi


def hashed_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, text, hash) of every word."""
    starts, ends, text = spans.word_spans(data, offs)
    return starts, ends, text, spans.span_hashes(data, starts, ends) if len(starts) else np.empty(0, np.uint64)


class Cutter:
    """Collects a task's texts into chunks, the same at each reading."""

    def __init__(self, codes: Codes):
        self.codes = codes
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.sizes, self.full, self.langs, self.docs, self.n = [], [], [], [], [], 0

    def add(self, docs, offs: np.ndarray, langs: list[str], words: tuple) -> Iterator[tuple[int, Chunk, list]]:
        """(name, chunk, the ``docs`` of its texts) whenever a chunk is full; ``words`` of ``hashed_words``."""
        *_, text, h = words
        self.hashes.append(h)
        self.sizes.append(np.bincount(text, minlength=len(offs) - 1))
        self.full.append(np.diff(offs) > 0)
        self.langs += langs
        self.docs.append(docs)
        self.n += len(h)
        if self.n >= self.codes.chunk_words:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, Chunk, list]]:
        if self.docs:
            yield self._chunk()

    def _chunk(self) -> tuple[int, Chunk, list]:
        words, full = np.concatenate(self.hashes), np.concatenate(self.full).astype(np.int64)
        offs = np.concatenate([[0], np.cumsum(np.concatenate(self.sizes))]).astype(np.int64)
        name = xxhash.xxh64(words.tobytes())
        for part in (offs.tobytes(), full.tobytes(), "\0".join(self.langs).encode()):
            name.update(part)
        h, inverse = np.unique(words, return_inverse=True)
        code = self.codes.of(h)
        order = np.argsort(code)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order)) + FIRST
        codes = np.concatenate([np.array([PAD, END], np.uint64), code[order]])
        docs, langs = self.docs, self.langs
        self._clear()
        return name.intdigest() >> 1, Chunk(codes, place[inverse], offs, full, langs), docs


def chunk_blocks(codes: Codes, name: int, chunk: Chunk) -> list[tuple]:
    """What a chunk sends to the ranges of its bigrams."""
    rows = []
    for lang in chunk.which:
        _, a, b, n = chunk.grams(lang)
        a, b = chunk.codes[a], chunk.codes[b]
        rows += [(GRAMS, lang, part, name, pack_grams(a[at], b[at], n[at]), None) for part, at in in_parts(codes.gram_part(a, b))]
    return rows


def contexts(a: np.ndarray, n: np.ndarray | None = None):
    """The different first words of a block (sorted) and their counts; the end of texts stands
    behind their start, as often."""
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
    w = a[first]
    count = np.add.reduceat(n.astype(np.int64), first) if n is not None and len(a) else np.zeros(len(w), np.int64)
    if len(w) and w[0] == PAD:
        w, count = np.insert(w, 1, END), np.insert(count, 1, count[0])
    return w, count


# -- ranges ----------------------------------------------------------------------------------
def array_file(folder: str, name: str, lang: str, first: np.ndarray, second: np.ndarray | None, *columns: np.ndarray) -> None:
    """Store sorted hashes of (language,) words with their values."""
    h = spans.mix64(first + np.uint64(_lang_seed(lang)))
    if second is not None:
        h = spans.mix64(h * np.uint64(0xD6E8FEB86659FD93) + second)
    order = np.argsort(h)
    # Of a range's million hashes the upper 40 bits tell them apart.
    write_file(f"{folder}/{name}.harr", pack_words(h[order] >> np.uint64(24), *(c[order] for c in columns)))


def _lang_seed(lang: str) -> int:
    import zlib

    return zlib.crc32(lang.encode())


def _grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows that agree in the keys."""
    at, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            key = tuple(r[k] for k in keys)
            if key != at and rows:
                yield at, rows
                rows = []
            at = key
            rows.append(r)
    if rows:
        yield at, rows


def add_grams(blocks: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(first, second, counts) of a range's sorted different bigrams, and each block's places in them."""
    a, b, n = (np.concatenate(x) for x in zip(*blocks))
    both = _numbered(a, b)
    order = np.argsort(both[0] << np.uint64(32) | both[1])
    sa, sb = a[order], b[order]
    new = np.concatenate([[True], (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    total = np.add.reduceat(n[order].astype(np.int64), first)
    return sa[first], sb[first], total, np.split(place, np.cumsum([len(x[0]) for x in blocks])[:-1])


def _numbered(*codes: np.ndarray) -> list[np.ndarray]:
    """The codes as numbers of 32 bits in the same order: hashes by their place among those that occur."""
    rare = np.unique(np.concatenate([c[c >= RARE] for c in codes]))
    return [np.where(c >= RARE, np.uint64(1 << 31) + np.searchsorted(rare, c).astype(np.uint64), c) for c in codes]


def _by_word(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of equal codes."""
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], codes[order][1:] != codes[order][:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[order][first], np.add.reduceat(values[order], first, axis=0, dtype=values.dtype) if len(codes) else values


def _count_ranges(codes: Codes, folder: str):
    """Blocks of bigrams to answers, questions and sums by word, and counts of counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        level: dict[str, np.ndarray] = {}

        def sums(lang: str) -> list[tuple]:
            w, v = _by_word(*(np.concatenate(x) for x in zip(*held.pop(lang))))
            return [(SUMS, lang, part, -1, pack_words(w[at], *(np.ascontiguousarray(c) for c in v[at].T)), None)
                    for part, at in in_parts(codes.word_part(w))]

        for (lang, part), rows in _grouped(batches, "lang", "part"):
            blocks = [unpack_grams(r["blob"]) for r in rows]
            a, b, total, places = add_grams(blocks)
            yield from _rows([(GRAM_ANSWER, lang, part, r["chunk"], pack(total[p].astype(np.uint32)), None) for r, p in zip(rows, places)])
            for r, (x, _, n) in zip(rows, blocks):  # a chunk's words ask with the bigrams that they begin
                w, n = contexts(x, n)
                yield from _rows([(WORDS, lang, home, r["chunk"], pack_words(w[at], n[at].astype(np.uint32)), [part])
                                  for home, at in in_parts(codes.word_part(w))])
            del blocks
            level[lang] = level.get(lang, 0) + np.array([(total == k).sum() for k in (1, 2, 3, 4)])
            again = total > 1
            array_file(folder, f"grams-{_lang_seed(lang):08x}-{part:06d}", lang, a[again], b[again], total[again].astype(np.uint32))
            kinds = np.stack([total == 1, total == 2, total > 2, np.zeros(len(total), bool)], axis=1).astype(np.uint32)
            held.setdefault(lang, []).append(_by_word(a, kinds))
            b, n = np.unique(b, return_counts=True)
            held[lang].append((b, np.stack([np.zeros(len(n), np.uint32)] * 3 + [n.astype(np.uint32)], axis=1)))
            if sum(len(x[0]) for x in held[lang]) > HELD_STATS:
                yield from _rows(sums(lang))
        for lang in list(held):
            yield from _rows(sums(lang))
        yield from _rows([(LEVEL, lang, 2, -1, b"", t.tolist()) for lang, t in level.items()])

    return run


def _word_ranges(folder: str):
    """Words of chunks and sums by word to answers and counts of counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level: dict[str, np.ndarray] = {}
        for (lang, part), rows in _grouped(batches, "lang", "part"):
            asked = [r for r in rows if r["kind"] == WORDS]
            blocks = [unpack_words(r["blob"], np.uint32) for r in asked]
            added = [unpack_words(r["blob"], *[np.uint32] * 4) for r in rows if r["kind"] == SUMS]
            w = np.unique(np.concatenate([x[0] for x in blocks + added]))
            seen, counts = np.zeros(len(w), np.int64), np.zeros((4, len(w)), np.int64)
            places = [np.searchsorted(w, x[0]) for x in blocks]
            for at, (_, n) in zip(places, blocks):
                seen[at] += n
            for x, *columns in added:
                counts[:, np.searchsorted(w, x)] += np.array(columns, np.int64)
            before = counts[3]
            values = np.stack([seen, *counts]).astype(np.uint32)
            yield from _rows([(WORD_ANSWER, lang, part, r["chunk"], pack(values[:, at].ravel()), r["t"]) for r, at in zip(asked, places)])
            again = seen > 1
            array_file(folder, f"words-{_lang_seed(lang):08x}-{part:06d}", lang, w[again], None, *(v[again] for v in values))
            n = [(before == k).sum() for k in (1, 2, 3, 4)]
            level[lang] = level.get(lang, 0) + np.array([*n, before.sum(), (before > 0).sum(), (before > 2).sum()])
        yield from _rows([(LEVEL, lang, 1, -1, b"", t.tolist()) for lang, t in level.items()])

    return run


def _discounts(level: DataFrame) -> DataFrame:
    """(of, d1, d2, d3, ...) of each language from its counts of counts t[0..3]."""
    n = 7
    t = level.groupBy(F.col("lang").alias("of")).agg(*[F.sum(F.get("t", F.lit(k))).alias(f"t{k + 1}") for k in range(n)])
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
    d = [F.when(F.col(f"t{k}") > 0, F.greatest(k - (k + 1) * y * F.col(f"t{k + 1}") / F.col(f"t{k}"), F.lit(0.1))) for k in (1, 2, 3)]
    return t.select("of", *[F.coalesce(x, F.lit(0.5 * k)).alias(f"d{k}") for k, x in zip((1, 2, 3), d)], *[f"t{k + 1}" for k in range(n)])


def _cut(n: np.ndarray, d) -> np.ndarray:
    return np.where(n == 1, d[0], np.where(n == 2, d[1], d[2]))


def chunk_surprise(chunk: Chunk, codes: Codes, answers: dict[str, tuple]) -> np.ndarray:
    """-log p of each unit; ``answers`` by language: counts of bigrams, (seen, bigrams it begins once, twice and
    more often, before) of words in the order of their blocks, discounts of order 2 and (total, freed, size,
    discounts) of order 1."""
    out = np.zeros(len(chunk.units))
    size_of = np.diff(chunk.offs)
    for lang in chunk.which:
        if lang not in answers:  # nothing but empty texts
            continue
        counts, words, d2, (total, freed1, size, *d1) = answers[lang]
        at, a, b, _, inverse = chunk.grams(lang, True)
        parts = [x for _, x in in_parts(codes.gram_part(chunk.codes[a], chunk.codes[b]))]
        order = np.concatenate([np.empty(0, np.int64), *parts])
        c = np.empty(len(a))
        c[order] = counts
        asked = [w[x] for w in (contexts(a[part])[0] for part in parts) for _, x in in_parts(codes.word_part(chunk.codes[w]))]
        asked = np.concatenate([np.empty(0, np.int64), *asked])
        seen, freed, before = np.zeros((3, len(chunk.codes)))
        for column, values in ((seen, words[0]), (freed, d2[0] * words[1] + d2[1] * words[2] + d2[2] * words[3]), (before, words[4])):
            column[asked] = values
        text, c, v, u = chunk.text[at], c[inverse], chunk.before[at], chunk.units[at]

        def elsewhere(found: np.ndarray, key: np.ndarray) -> np.ndarray:
            """Whether a key occurs more often than in the unit's own text: sure beyond the text's size."""
            known = found > size_of[text]
            unsure = np.flatnonzero(~known & (found > 1))
            if len(unsure):
                _, which, own = np.unique(text[unsure].astype(np.int64) * (int(key.max()) + 1) + key[unsure], return_inverse=True, return_counts=True)
                known[unsure] = found[unsure] > own[which]
            return known

        word = elsewhere(seen[u], u)
        # A text begins as many bigrams with a word as it has of it, and one with its start.
        context = np.where(v == PAD, seen[PAD] > 1, np.concatenate([[False], word[:-1]]))
        n = np.where(word, before[u], 0)
        p = (np.where(n > 0, n - _cut(n, d1), 0) + freed1 / size) / total
        c = np.where(elsewhere(c, inverse), c, 0)
        p2 = (np.where(c > 0, c - _cut(c, d2), 0) + freed[v] * p) / np.maximum(seen[v], 1)
        out[at] = -np.log(np.where(context, p2, p))
    return out


# -- the whole --------------------------------------------------------------------------------
def _answer_files(folder: str):
    """All answers of a chunk into its file: per language the bigrams' counts, the words' columns and the discounts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for (chunk,), rows in _grouped(batches, "chunk"):
            out = []
            for lang in sorted({r["lang"] for r in rows}):
                grams = [r for r in rows if r["kind"] == GRAM_ANSWER and r["lang"] == lang]
                words = [r for r in rows if r["kind"] == WORD_ANSWER and r["lang"] == lang]
                counts = np.concatenate([unpack(r["blob"], np.uint32) for r in grams])
                columns = np.concatenate([unpack(r["blob"], np.uint32).reshape(5, -1) for r in words], axis=1)
                out += [lang.encode(), np.array(grams[0]["p"]).tobytes(), np.array(words[0]["p"]).tobytes(), pack(counts), pack(columns.ravel())]
            write_file(f"{folder}/answers-{chunk:016x}", _join(*out))
            done += 1
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["chunks"])

    return run


def _read_answers(uri: str) -> dict[str, tuple]:
    out, parts = {}, _split(read_file(uri))
    for lang, second, first, grams, words in zip(*(parts[k::5] for k in range(5))):
        out[lang.decode()] = (unpack(grams, np.uint32), unpack(words, np.uint32).reshape(5, -1), np.frombuffer(second),
                              np.frombuffer(first).tolist())
    return out


def _scan_of_files(docs: DataFrame) -> bool:
    plan = docs._jdf.queryExecution().executedPlan().toString()
    return bool(docs.inputFiles()) and not any(x in plan for x in ("Exchange", "Join", "Sample", "Limit"))


def _forget(spark) -> None:
    """Spark removes the shuffle files of finished steps once their plans are collected, which takes two
    collections of the driver's objects: ask for them."""
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def score_texts(docs: DataFrame, prepare, finish, out_schema, name: str, text_col: str = "text", chunk_words: int = 0) -> DataFrame:
    """Rows made of every text and the surprise of its units, stored.

    ``docs``: (row, text, lang).  In tasks ``prepare(row, langs, data, offs, words)`` gives what is kept of
    some texts, and ``finish(that, surprise, offs)`` the result's batches.  Tasks hold what is kept
    of a chunk: ``chunk_words`` makes chunks smaller than ``CHUNK_WORDS`` where that is much.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("row", F.col(text_col).alias("text"), "lang")
    if not _scan_of_files(docs):
        docs = materialize(docs, "texts")
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, before or str(spark.sparkContext.defaultParallelism))
    try:
        return _score_scan(docs, prepare, finish, out_schema, name, chunk_words or CHUNK_WORDS)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _score_scan(docs: DataFrame, prepare, finish, out_schema, name: str, chunk_words: int) -> DataFrame:
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    codes = fit_codes(docs, "text", chunk_words)
    _forget(spark)
    shared = spark.sparkContext.broadcast(codes)
    folder, answered = shared_uri(spark, "word-model"), shared_uri(spark, "answers")

    def pieces(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data, offs = spans.text_buffer(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for lo, hi in spans.chunks(offs):
                d, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                yield batch, lo, hi, d, o, langs[lo:hi], hashed_words(d, o)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(shared.value)
        for *_, o, langs, words in pieces(batches):
            for number, chunk, _ in cutter.add(None, o, langs, words):
                yield from _rows(chunk_blocks(shared.value, number, chunk))
        for number, chunk, _ in cutter.flush():
            yield from _rows(chunk_blocks(shared.value, number, chunk))

    def dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        return df.repartition(n_parts, *keys).sortWithinPartitions(*order)

    blocks = docs.mapInArrow(task(cut), _ROW)
    counted = materialize(dealt(blocks, ["lang", "part"], ["lang", "part"]).mapInArrow(task(_count_ranges(codes, folder)), _ROW), "bigrams")
    _forget(spark)
    d2 = _few(materialize(_discounts(counted.where(F.col("kind") == LEVEL)), "discounts"))
    by_word = counted.where(F.col("kind").isin(WORDS, SUMS))
    words = materialize(dealt(by_word, ["lang", "part"], ["lang", "part"]).mapInArrow(task(_word_ranges(folder)), _ROW), "words")
    _forget(spark)
    d1 = _few(materialize(_discounts(words.where(F.col("kind") == LEVEL)), "discounts"))

    freed = F.col("d1") * F.col("t1") + F.col("d2") * F.col("t2") + F.col("d3") * F.col("t7")
    first = F.array(*[x.cast("double") for x in (F.col("t5"), freed, F.col("t6") + 1, F.col("d1"), F.col("d2"), F.col("d3"))])
    second = F.array("d1", "d2", "d3")
    with_p = lambda df, kind, d, p: (df.where(F.col("kind") == kind).join(d, F.col("lang") == F.col("of"), "left")
                                     .select("kind", "lang", "part", "chunk", "blob", "t", p.alias("p")))
    answers = with_p(counted, GRAM_ANSWER, d2, second).union(with_p(words, WORD_ANSWER, d1, first))
    answers = dealt(answers, ["chunk"], ["chunk", "kind", "lang", "t", "part"]).mapInArrow(task(_answer_files(answered)), "chunks long")
    materialize(answers, "answers")
    discard(spark, counted.stored_at, words.stored_at)  # the answers are in files of their own now
    _forget(spark)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(number: int, chunk: Chunk, kept: list) -> Iterator[pa.RecordBatch]:
            answers = _read_answers(f"{answered}/answers-{number:016x}") if len(chunk.units) else {}
            surprise, at = chunk_surprise(chunk, shared.value, answers), 0
            for part in kept:
                cut = chunk.offs[at:at + part.num_rows + 1]
                at += part.num_rows
                yield from finish(part, surprise[cut[0]:cut[-1]], cut - cut[0])

        cutter = Cutter(shared.value)
        for batch, lo, hi, d, o, langs, words in pieces(batches):
            for full in cutter.add(prepare(batch.column("row").slice(lo, hi - lo), langs, d, o, words), o, langs, words):
                yield from done(*full)
        for full in cutter.flush():
            yield from done(*full)

    out = materialize(docs.mapInArrow(task(score), out_schema), name)
    discard(spark, answered)
    _forget(spark)
    return out


def _few(d: DataFrame) -> DataFrame:
    """A row per language: broadcast while they are few."""
    return F.broadcast(d) if d.count() <= BROADCAST_LANGUAGES else d
