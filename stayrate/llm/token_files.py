"""Token-ID / binary output: patched frame-of-reference blocks.

A token file holds the ids of consecutive documents in blocks of 1,024 ids.
A block stores its minimum and the differences to it in a bit width chosen at
a percentile of the block's differences; a difference that needs more bits
keeps its low bits in place and its position and high bits in the block's
exception list.  The footer indexes where each block starts and lists the
documents (id, number of ids), so a reader can jump to any document.

File layout (little endian): 8-byte magic; the blocks (16-byte header: count
u32, minimum u32, exceptions u32, width u32; packed 64-bit words; exception
positions u16; exception high bits u32); block starts u64; document ids i64;
id-is-null flags u8; document lengths u32; counts of blocks and documents
u64; footer offset u64; magic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.store import materialize, read_file, shared_uri, ship, task, write_file
from stayrate.llm.tokens import BATCH_ROWS, CHUNK_BYTES, encoder, forget

MAGIC = b"PFORIDS1"
BLOCK = 1024
#: Share of a block's differences that the packed width must hold.
PERCENTILE = 0.9
#: Ids after which a task starts its next file (a longer document has its own).
FILE_IDS = 1_000_000


# -- blocks ------------------------------------------------------------------
def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 1024) values below 2**width as (blocks, 16 * width) words."""
    v = values.reshape(len(values), BLOCK // 64, 64)
    out = np.zeros((len(values), BLOCK // 64, width), np.uint64)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        out[:, :, word] |= v[:, :, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= v[:, :, j] >> np.uint64(64 - shift)
    return out.reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``_pack``."""
    w = words.reshape(len(words), BLOCK // 64, width)
    out = np.zeros((len(words), BLOCK // 64, 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64 if width else 0):
        word, shift = divmod(j * width, 64)
        x = w[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            x = x | (w[:, :, word + 1] << np.uint64(64 - shift))
        out[:, :, j] = x & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Encoded blocks of an id array, and where each starts."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return [], np.empty(0, np.uint64)
    full = np.empty(blocks * BLOCK, np.uint64)
    full[:n] = ids
    full[n:] = ids[(blocks - 1) * BLOCK:].min()  # padding, below no real value
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    diff = full - low[:, None]
    at = np.partition(diff, int(PERCENTILE * (BLOCK - 1)), axis=1)[:, int(PERCENTILE * (BLOCK - 1))]
    width = np.zeros(blocks, np.int64)
    for b in range(32):
        width[at >= np.uint64(1 << b)] = b + 1
    out: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        d = diff[rows]
        words = _pack(d & np.uint64((1 << w) - 1), w)
        high = d >> np.uint64(w)
        for k, r in enumerate(rows.tolist()):
            pos = np.flatnonzero(high[k])
            head = np.array([min(BLOCK, n - r * BLOCK), low[r], len(pos), w], np.uint32)
            out[r] = b"".join((head.tobytes(), words[k].tobytes(), pos.astype(np.uint16).tobytes(),
                               high[k][pos].astype(np.uint32).tobytes()))
    starts = np.cumsum([len(MAGIC), *map(len, out)])[:-1].astype(np.uint64)
    return out, starts


def decode_blocks(buf: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks that start at the given places."""
    heads = np.array([np.frombuffer(buf, np.uint32, 4, int(s)) for s in starts], np.int64).reshape(-1, 4)
    out = np.empty((len(starts), BLOCK), np.uint64)
    for w in np.unique(heads[:, 3]).tolist():
        rows = np.flatnonzero(heads[:, 3] == w)
        n_words = BLOCK // 64 * w
        words = np.array([np.frombuffer(buf, np.uint64, n_words, int(starts[r]) + 16) for r in rows],
                         np.uint64).reshape(len(rows), n_words)
        out[rows] = _unpack(words, w)
        for r in rows[heads[rows, 2] > 0].tolist():
            at, k = int(starts[r]) + 16 + 8 * n_words, int(heads[r, 2])
            pos = np.frombuffer(buf, np.uint16, k, at)
            out[r, pos] |= np.frombuffer(buf, np.uint32, k, at + 2 * k).astype(np.uint64) << np.uint64(w)
    out += heads[:, 1].astype(np.uint64)[:, None]
    keep = np.arange(BLOCK)[None, :] < heads[:, 0][:, None]
    return out[keep].astype(np.uint32)


# -- files -------------------------------------------------------------------
def file_bytes(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> list[bytes]:
    blocks, starts = encode_blocks(ids)
    footer = len(MAGIC) + sum(map(len, blocks))
    null = np.array([d is None for d in doc_ids], np.uint8)
    keys = np.array([0 if d is None else d for d in doc_ids], np.int64)
    return [MAGIC, *blocks, starts.tobytes(), keys.tobytes(), null.tobytes(),
            np.array(lengths, np.uint32).tobytes(),
            np.array([len(starts), len(keys), footer], np.uint64).tobytes(), MAGIC]


def parse_file(buf: bytes) -> tuple[np.ndarray, list[int | None], np.ndarray]:
    """(ids, document ids, lengths) of a token file; raises on a damaged one."""
    if buf[:8] != MAGIC or buf[-8:] != MAGIC:
        raise ValueError("not a whole token file")
    n_blocks, n_docs, at = (int(x) for x in np.frombuffer(buf, np.uint64, 3, len(buf) - 32))
    starts = np.frombuffer(buf, np.uint64, n_blocks, at)
    at += 8 * n_blocks
    keys = np.frombuffer(buf, np.int64, n_docs, at).tolist()
    null = np.frombuffer(buf, np.uint8, n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(buf, np.uint32, n_docs, at + 9 * n_docs).astype(np.int64)
    ids = decode_blocks(buf, starts) if n_blocks else np.empty(0, np.uint32)
    if lengths.sum() != len(ids):
        raise ValueError("document lengths do not add up to the ids")
    return ids, [None if z else k for k, z in zip(keys, null)], lengths


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize documents and write token files in ascending id order.

    Returns the manifest (part, file, uri, n_docs, n_ids), itself stored in
    the shared folder.  Documents are range-partitioned and sorted by id (null
    ids first; rows with equal ids by a hash of their text), each task writes
    the files of its range.  A null text is empty; every document gets
    ``end_id`` appended, so an empty one has one id.  Other columns are
    ignored.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or shared_uri(spark, "token-files")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        keys: list[int | None] = []
        lengths: list[int] = []
        files: list[tuple] = []

        def flush() -> None:
            if keys:
                uri = f"{path}/part-{part:06d}-{len(files):06d}.pfor"
                all_ids = np.concatenate(ids)
                write_file(uri, *file_bytes(all_ids, keys, lengths))
                files.append((part, len(files), uri, len(keys), len(all_ids)))
                ids.clear(), keys.clear(), lengths.clear()

        held = 0
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for lo, hi in spans.chunks(offs, CHUNK_BYTES):
                got, at = enc.encode_many(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                got = np.insert(got, at[1:], np.uint32(end_id))
                ids.append(got)
                keys.extend(doc_ids[lo:hi])
                lengths.extend((np.diff(at) + 1).tolist())
                held += len(got)
                if held >= FILE_IDS:
                    flush()
                    held = 0
        flush()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*files), (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["part", "file", "uri", "n_docs", "n_ids"])

    manifest = rows.mapInArrow(task(write), "part long, file long, uri string, n_docs long, n_ids long")
    return materialize(manifest, "token-manifest", BATCH_ROWS)


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of the token files: doc_id, start (ids before it in all files),
    n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    ship(spark)
    order = Window.orderBy("part", "file")  # one row per file of millions of ids
    files = manifest.withColumn("base", F.coalesce(
        F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = files.select("uri", "base").repartition(n, "uri")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker that has tokenized before needs its tables no more
        for batch in batches:
            for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, keys, lengths = parse_file(read_file(uri))
                at = np.concatenate([[0], np.cumsum(lengths)])
                raw = ids.astype("<u4").tobytes()  # bytes: an Arrow array made of memoryviews keeps them for good
                step = 512
                for lo in range(0, len(keys), step):
                    hi = min(lo + step, len(keys))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[lo:hi], pa.int64()), pa.array(base + at[lo:hi], pa.int64()),
                        pa.array(lengths[lo:hi], pa.int64()),
                        pa.array([raw[4 * at[k]:4 * at[k + 1]] for k in range(lo, hi)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(task(read), "doc_id long, start long, n_tokens long, ids binary")
