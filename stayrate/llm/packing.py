"""Best-fit packing of token pieces, after Martello-Toth dominance reduction.

Bin packing only looks at lengths, and there are at most ``capacity`` of
them.  So the plan is made from the histogram of piece lengths, a table whose
size the capacity bounds whatever the number of pieces: first the reduction
fixes small sets that provably dominate every other set with the same longest
piece, many equal sets at a time; then the remainder is packed best-fit, the
longest first, again many equal sequences at a time.  A plan is a list of
placements "the next n pieces of length L go to sequences base, base + 1, ...
at this offset".  Pieces are numbered within their length by a two-level
count (buckets of a hash, so that a length that a third of all pieces share is
no task's own), and look up their placement by number.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stayrate.llm import spans
from stayrate.llm.store import materialize, ship, task
from stayrate.llm.tokens import BATCH_ROWS, CHUNK_BYTES, encoder

#: Pieces numbered by one task at a time, on average.
BUCKET_ROWS = 20_000


# -- the plan ------------------------------------------------------------------
def reduce_dominated(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction of ``count[length]``, in place.

    From the longest length j down, a set with j is fixed when it dominates
    every feasible set with j: {j} if nothing fits beside it; {j, k} with k the
    longest that fits, if k fills the sequence exactly, or only one piece fits
    beside j, or at most two fit and no two are longer together than k.
    Returns (lengths, how many such sequences).
    """
    fixed: list[tuple[tuple[int, ...], int]] = []
    j = capacity
    while j > 0:
        if count[j] == 0:
            j -= 1
            continue
        room = capacity - j
        count[j] -= 1  # the piece itself is no companion
        fits = np.flatnonzero(count[:room + 1])
        k = int(fits[-1]) if len(fits) else 0
        if not k:
            count[j] += 1
            n = int(count[j]) if room < j else 1
            fixed.append(((j,), n))
            count[j] -= n
            continue
        dominates = k == room
        if not dominates:
            smallest = np.repeat(fits[:3], np.minimum(count[fits[:3]], 3))[:3]
            two = int(smallest[:2].sum()) if len(smallest) > 1 else room + 1
            three = int(smallest.sum()) if len(smallest) > 2 else room + 1
            if two > room:
                dominates = True
            elif three > room:
                # The longest pair that fits: each piece with the longest second one.
                second = np.searchsorted(fits, np.minimum(room - fits, fits), "right") - 1
                second -= (second >= 0) & (fits[second] == fits) & (count[fits] < 2)
                dominates = int((fits + fits[second])[second >= 0].max(initial=0)) <= k
        count[j] += 1
        if not dominates:
            j -= 1
            continue
        n = int(count[j] // 2 if k == j else min(count[j], count[k]))
        fixed.append(((j, k), n))
        count[j] -= n
        count[k] -= n
    return fixed


def plan(histogram: dict[int, int], capacity: int) -> tuple[dict[int, tuple[np.ndarray, ...]], int]:
    """Placements by length, and the number of sequences.

    For each length: rising first numbers, first sequences and offsets of its
    placements; a piece with number r in placement p goes to sequence
    ``sequence[p] + r - first[p]`` at ``offset[p]``.
    """
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if not 0 < length <= capacity:
            raise ValueError(f"piece length {length} is not in 1..{capacity}")
        count[length] = n
    placed: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequences = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        placed.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
        taken[length] = taken.get(length, 0) + n

    for lengths, n in reduce_dominated(count, capacity):
        offset = 0
        for x in lengths:
            place(x, n, sequences, offset)
            offset += x
        sequences += n
    # Best fit on groups of equal sequences: room left -> [(first sequence, how many)].
    groups: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, n))

    for length in range(capacity, 0, -1):
        left = int(count[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                # Best fit fills a new sequence with this length before it opens the next.
                each = capacity // length
                full, rest = divmod(left, each)
                for k in range(each):
                    if full + (k < rest):
                        place(length, full + (k < rest), sequences, k * length)
                add(capacity - each * length, sequences, full)
                if rest:
                    add(capacity - rest * length, sequences + full, 1)
                sequences += full + (rest > 0)
                break
            room = rooms[at]
            first, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            m = min(left, n)
            place(length, m, first, capacity - room)
            add(room - length, first, m)
            add(room, first + m, n - m)
            left -= m
    return {x: tuple(np.array(c, np.int64) for c in zip(*p)) for x, p in placed.items()}, sequences


# -- the job --------------------------------------------------------------------
def tokenize_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids_crc32 (and ids, binary).

    A null text is empty; every document ends with ``end_id``, so it has at
    least one piece.  Only documents longer than ``capacity`` are cut.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in spans.chunks(offs, CHUNK_BYTES):
                got, at = enc.encode_many(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                got = np.insert(got, at[1:], np.uint32(end_id)).astype("<u4")
                raw = got.tobytes()  # bytes: an Arrow array made of memoryviews keeps them for good
                ends = (at + np.arange(len(at))).tolist()
                out = []
                for k, doc in enumerate(doc_ids[lo:hi]):
                    for p, a in enumerate(range(ends[k], ends[k + 1], capacity)):
                        b = min(a + capacity, ends[k + 1])
                        piece = raw[4 * a:4 * b]
                        out.append((doc, p, a - ends[k], b - a, zlib.crc32(piece), piece)[:len(names)])
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return rows.mapInArrow(task(cut), "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def pack(pieces: DataFrame, capacity: int, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (a same-named column is replaced).

    ``pieces`` is read several times, so pass a stored table.  Lengths are
    1..capacity; a null length gets no sequence (nulls).  Equal and repeated
    rows are pieces of their own.  An empty table stays empty.
    """
    spark = pieces.sparkSession
    ship(spark)
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row = F.struct(*keep).alias("row")
    bounded = pieces.groupBy(F.col(length_col).alias("x")).count().where("x IS NOT NULL")
    histogram = {r["x"]: r["count"] for r in bounded.collect()}  # at most `capacity` rows
    placed, _ = plan(histogram, capacity)
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    hashed = pieces.select(row, F.col(length_col).alias("x"), F.xxhash64(*keep).alias("h"))
    hashed = hashed.withColumn("b", F.pmod("h", F.lit(buckets)).cast("int"))
    sizes = hashed.where("x IS NOT NULL").groupBy("x", "b").count()
    before = Window.partitionBy("x").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("x", "b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("x", "b").orderBy("h")
    numbered = (hashed.join(bases, ["x", "b"], "left")
                .select("row", "x", (F.col("base") + F.row_number().over(inside) - 1).alias("r")))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").cast(pa.int64())
            r = batch.column("r").fill_null(0).to_numpy(zero_copy_only=False)
            length = x.fill_null(0).to_numpy(zero_copy_only=False)
            seq, off = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
            for v in np.unique(length[length > 0]).tolist():
                at = np.flatnonzero(length == v)
                first, sequence, offset = placed[v]
                p = np.searchsorted(first, r[at], "right") - 1
                seq[at] = sequence[p] + r[at] - first[p]
                off[at] = offset[p]
            none = length == 0
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(seq, mask=none), pa.array(off, mask=none)],
                                             names=["row", "sequence_id", "offset"])

    schema = StructType([numbered.schema["row"], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return numbered.mapInArrow(task(look_up), schema).select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids as whole sequences: sequence_id, n_tokens, ids (binary)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids
    joined = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack documents; one row per piece."""
    pieces = materialize(tokenize_pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids),
                         "pieces", BATCH_ROWS)
    return pack(pieces, capacity)
