"""SimHash near-duplicates by a binary trie self-join.

Fingerprints link when at most ``bits`` of their 64 bits differ.  Cut into
``bits + 1`` blocks, two such fingerprints agree on a whole block, so each
distinct fingerprint goes, once per block, to the trie of the fingerprints
that share it, with that block as the trie's root path.  Within a task the
tries of all its blocks are joined with themselves: pairs of nodes descend
together, a pair whose paths differ in one more bit spends one unit of the
Hamming budget, and a pair beyond the budget is pruned with everything below
it.  A task keeps only which fingerprints are connected and hands on one link
per fingerprint, never all pairs of a group.  A block value that very many
distinct fingerprints share is split again by blocks of its remaining bits.

Exact copies share a fingerprint, which is one row whatever their number.

Defined results: a null or empty text has fingerprint zero and links like any
other; rows with a null id count, a group of only null ids has a null
component; repeated rows are documents of their own; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm import spans
from stayrate.llm.components import components, merge_links
from stayrate.llm.store import keyed_rows, materialize, ship, task

SEED = 42
#: Distinct fingerprints of one block value from which it is split again.
SPLIT_ROWS = 20_000
#: Node pairs, and fingerprint pairs below them, held at a time.
FRONTIER = 1 << 18
LEAF = 64


# -- fingerprints ----------------------------------------------------------------
def fingerprints(data: np.ndarray, offs: np.ndarray, shingle: int) -> np.ndarray:
    """64-bit fingerprints of the texts of a buffer."""
    n = len(offs) - 1
    out = np.zeros(n, np.uint64)
    starts, ends, text = spans.word_spans(data, offs)
    if not len(starts):
        return out
    upper = (data >= 0x41) & (data <= 0x5A)
    data = data + (upper.astype(np.uint8) << 5)
    # One space after each word instead of any white space.
    keep = np.zeros(len(data) + 1, bool)
    cover = np.zeros(len(data) + 1, np.int8)
    cover[starts] = 1
    np.subtract.at(cover, ends, 1)
    keep = np.cumsum(cover, dtype=np.int8)[:-1] > 0
    gap = np.zeros(len(data) + 1, bool)
    gap[ends] = True
    gap = gap[:-1] & ~keep
    flat = np.where(gap, 0x20, data)[keep | gap].tobytes()
    moved = np.concatenate([[0], np.cumsum(keep | gap)])
    s, e = moved[starts], moved[ends]
    words = np.bincount(text, minlength=n)
    first = np.concatenate([[0], np.cumsum(words)])
    # Shingles: windows inside one text, or the whole of a shorter text.
    short = np.flatnonzero((words > 0) & (words < shingle))
    at = np.flatnonzero(text[:len(text) - shingle + 1] == text[shingle - 1:]) if len(text) >= shingle else np.empty(0, np.int64)
    a = np.concatenate([s[at], s[first[short]]])
    b = np.concatenate([e[at + shingle - 1], e[first[short + 1] - 1]])
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())], np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    per = np.maximum(words - shingle + 1, 0)
    ends_at = np.cumsum(per).tolist()
    counts = np.zeros((n, 64), np.int64)
    lo = 0
    for t, hi in enumerate(ends_at):
        if hi > lo:
            counts[t] = bits[lo:hi].sum(axis=0, dtype=np.int64)
        lo = hi
    counts[short] = bits[len(at):]
    per[short] = 1
    return np.packbits(2 * counts > per[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def with_fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text",
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fingerprint as a long, carried columns) of every document, stored."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                       *[F.col(c) for c in carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = spans.text_buffer(batch.column(0))
            fp = [fingerprints(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], shingle)
                  for lo, hi in spans.chunks(offs)]
            fp = np.concatenate(fp).view(np.int64) if fp else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(fp), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    extra = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return materialize(rows.mapInArrow(task(run), f"doc_id long, fp long{extra}"), "fingerprints")


# -- the trie join ------------------------------------------------------------------
def trie_links(group: np.ndarray, key: np.ndarray, bits: int, width: int = 64) -> np.ndarray:
    """Labels (index of the smallest connected row) of rows sorted by (group, key).

    Each group is one trie over its keys.  Node pairs are index ranges that
    share their path's leading bits except for the differences counted so far.
    """
    n = len(key)
    label = np.arange(n)
    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    lo, hi = edge[:-1], edge[1:]
    some = hi - lo > 1
    zero = np.zeros(int(some.sum()), np.int8)
    ones: dict[int, np.ndarray] = {}
    stack = [(0, lo[some], hi[some], lo[some], hi[some], zero)]
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        if len(al) > FRONTIER:
            half = len(al) // 2
            stack.append((depth, *(x[half:] for x in (al, ah, bl, bh, diff))))
            stack.append((depth, *(x[:half] for x in (al, ah, bl, bh, diff))))
            continue
        leaf = ((ah - al) * (bh - bl) <= LEAF) | (depth == width)
        if leaf.any():
            _leaf_pairs(label, key, al[leaf], ah[leaf], bl[leaf], bh[leaf], bits)
            al, ah, bl, bh, diff = (x[~leaf] for x in (al, ah, bl, bh, diff))
        if not len(al):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((key >> np.uint64(width - 1 - depth)) & np.uint64(1), dtype=np.int64)])
        c = ones[depth]
        am, bm = ah - (c[ah] - c[al]), bh - (c[bh] - c[bl])
        same = al == bl  # a node with itself: its mixed pair counts once
        kids = [(al, am, bl, bm, diff, None), (am, ah, bm, bh, diff, None),
                (al, am, bm, bh, diff + 1, None), (am, ah, bl, bm, diff + 1, ~same)]
        parts = []
        for xl, xh, yl, yh, d, also in kids:
            ok = (xh > xl) & (yh > yl) & (d <= bits)
            ok &= (xl != yl) | (xh - xl > 1)
            if also is not None:
                ok &= also
            parts.append([x[ok] for x in (xl, xh, yl, yh, d)])
        stack.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))
    return label


def _leaf_pairs(label, key, al, ah, bl, bh, bits) -> None:
    """Compare all keys below small node pairs, a bounded number at a time."""
    size = (ah - al) * (bh - bl)
    ends = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + FRONTIER * 4, "right")))
        s = size[lo:hi]
        k = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
        w = np.repeat(bh[lo:hi] - bl[lo:hi], s)
        a, b = np.repeat(al[lo:hi], s) + k // w, np.repeat(bl[lo:hi], s) + k % w
        near = (a < b) & (np.bitwise_count(key[a] ^ key[b]) <= bits)
        merge_links(label, a[near], b[near])
        lo = hi


def _blocks(width: int, n: int) -> list[tuple[int, int]]:
    """(shift, bits) of n blocks that make up a number of so many bits, highest first."""
    sizes = [width // n + (k < width % n) for k in range(n)]
    return [(width - sum(sizes[:k + 1]), s) for k, s in enumerate(sizes)]


def fingerprint_links(fps: DataFrame, bits: int) -> DataFrame:
    """Links (u, v) that connect what is within ``bits`` differing bits, from distinct fingerprints ``fp``.

    Rows on the way: ``path`` (which blocks agree, with their values), ``rest``
    (the bits not yet agreed on) and its ``width``.
    """
    spark = fps.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if bits == 0:
        return spark.createDataFrame([], "u long, v long")
    rows = fps.select("fp", F.lit(0).cast("long").alias("path"), F.col("fp").alias("rest"))
    out, width, depth = None, 64, 0
    while True:
        cuts = [_shared(shift, size, k) for k, (shift, size) in enumerate(_blocks(width, bits + 1))]
        rows = rows.select("fp", F.inline(F.array(*cuts)))
        width -= width // (bits + 1)
        depth += 1
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
        large = sizes.where(F.col("n") > SPLIT_ROWS).select("path")
        if depth == 3 or width < 2 * (bits + 1) or large.isEmpty():
            here, rows = rows, None
        else:
            here, rows = rows.join(large, "path", "left_anti"), rows.join(large, "path", "left_semi")
        links = _join_tries(here, bits, n)
        out = links if out is None else out.union(links)
        if rows is None:
            return out


def _shared(shift: int, size: int, k: int):
    """The path extended by one block's value, and the bits that remain."""
    mask = (1 << size) - 1
    value = F.shiftrightunsigned("rest", shift).bitwiseAND(F.lit(mask).cast("long"))
    low = F.col("rest").bitwiseAND(F.lit((1 << shift) - 1).cast("long"))
    high = F.shiftleft(F.shiftrightunsigned("rest", shift + size), shift) if shift + size < 64 else F.lit(0).cast("long")
    return F.struct(F.xxhash64("path", F.lit(k), value).alias("path"), high.bitwiseOR(low).alias("rest"))


def _join_tries(rows: DataFrame, bits: int, n: int) -> DataFrame:
    """One link per fingerprint to the smallest of its trie's component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches]
        if not got:
            return
        fp, path = (np.concatenate(x) for x in zip(*got))
        key = fp.view(np.uint64)
        order = np.lexsort((key, path))
        label = trie_links(path[order], key[order], bits)
        linked = np.flatnonzero(label != np.arange(len(label)))
        f = fp[order]
        yield pa.RecordBatch.from_arrays([pa.array(f[linked]), pa.array(f[label[linked]])], names=["u", "v"])

    return rows.select("fp", "path").repartition(n, "path").mapInArrow(task(run), "u long, v long")


def near_duplicates(marked: DataFrame, bits: int) -> DataFrame:
    """Add component (a label) and component_id (its smallest doc_id) to documents with fingerprints."""
    fps = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    found = components(fingerprint_links(fps.select("fp"), bits))
    owner = fps.join(found, fps["fp"] == found["node"], "left").select(
        F.col("fp"), F.coalesce("component", "fp").alias("component"), "first")
    first = owner.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = owner.select("fp", "component").join(first, "component")
    return marked.join(classes, "fp")


def deduplicate(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each group of near-duplicates: the smallest id's (null
    ids last; rows with equal ids by a hash of the row; one of equal rows)."""
    keyed = keyed_rows(docs, id_col, text_col)
    marked = near_duplicates(with_fingerprints(keyed, shingle, carry=("row_key",)), bits)
    same = marked.groupBy("component", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
    kept = same.groupBy("component").agg(F.min_by(F.struct("doc_id", "row_key", "n"), order).alias("k"))
    kept = materialize(kept.select(F.col("k.doc_id").alias("k_id"), F.col("k.row_key").alias("k_key"),
                                   F.col("k.n").alias("n")), "kept")
    if not kept.where("n > 1").isEmpty():
        keyed = keyed.dropDuplicates(["doc_id", "row_key"])
    stay = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("row_key") == F.col("k_key")), "left_semi")
    return stay.select("row.*")


def simhash_documents(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    found = near_duplicates(with_fingerprints(docs, shingle), bits)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
