"""WARC archives: one gzip member per record, written and read sequentially.

Writing: every page is one record.  Among pages with equal payloads of at
least ``min_bytes`` bytes the one with the largest id is the ``response``, the
others are ``revisit`` records that refer to it and carry no payload.
Reading: members are inflated incrementally, the header block is parsed, the
block is framed by its Content-Length, and block and payload digests are
verified, one record in memory at a time.

Defined results: null html is an empty payload; a null page id is smaller than
any other and a group of only null ids is all responses; repeated rows of the
largest id are all responses; other columns are ignored; an empty table gives
no archives.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm.store import FileWriter, materialize, open_file, shared_uri, ship, task

#: A task starts its next archive after so many bytes.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 16
_DATE = "1970-01-01T00:00:00Z"  # no capture time in the input; keeps re-runs identical
_COLUMNS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """A damaged archive: bad framing or a digest that does not match."""


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    n = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if n == "none" else int(n)


def _line(s: str | None) -> str:
    """A header value: no control characters, spaces as %20."""
    return "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in (s or "").encode()).encode("latin-1").decode("utf-8")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit keeps the payload's length and digest only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_line(url)}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is None:
        head.remove("WARC-Target-URI: ")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def members(stream) -> Iterator[bytes]:
    """Inflated gzip members of a stream, one after the other."""
    z, out, pending = None, [], b""
    while True:
        chunk = pending or stream.read(READ_BYTES)
        pending = b""
        if not chunk:
            if z is not None:
                raise WarcError("the archive ends inside a record")
            return
        z = z or zlib.decompressobj(31)
        try:
            out.append(z.decompress(chunk))
        except zlib.error as e:
            raise WarcError(f"bad gzip member: {e}") from e
        if z.eof:
            pending = z.unused_data
            yield b"".join(out)
            z, out = None, []


def parse_record(data: bytes) -> dict:
    """Headers, block and payload of a record; verifies framing and digests."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise WarcError("no WARC header")
    h = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    n = int(h["content-length"])
    block, tail = rest[:n], rest[n:]
    if len(block) != n or tail != b"\r\n\r\n":
        raise WarcError("the block does not fill its Content-Length")
    if "warc-block-digest" in h and h["warc-block-digest"] != "sha1:" + base32_sha1(block):
        raise WarcError("block digest does not match")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode("latin-1").split("\r\n")[1:])
    if h["warc-type"] == "response" and (h.get("warc-payload-digest") != "sha1:" + base32_sha1(payload)
                                         or int(fields["Content-Length"]) != len(payload)):
        raise WarcError("payload digest or length does not match")
    return {"page_id": _page(h["warc-record-id"]), "url": h.get("warc-target-uri"),
            "payload_bytes": int(fields["Content-Length"]),
            "payload_digest": h["warc-payload-digest"].removeprefix("sha1:"), "record_type": h["warc-type"],
            "refers_to": _page(h["warc-refers-to"]) if "warc-refers-to" in h else None,
            "payload": payload if h["warc-type"] == "response" else None}


def write_warc(pages: DataFrame, path: str | None = None, min_bytes: int = 0, id_col: str = "page_id",
               url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write archives; returns their manifest (uri, records), kept in the shared folder.

    Equal payloads are grouped by SHA-1 and length with a map-side maximum, so
    a payload of a third of all pages is one row per task in the shuffle; only
    groups with more than one page join back to the pages (a skewed join that
    AQE splits).
    """
    spark = pages.sparkSession
    ship(spark)
    path = path or shared_uri(spark, "warc")
    body = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha1("body")).withColumn("size", F.octet_length("body"))
    first = (rows.where(F.col("size") >= min_bytes).groupBy("digest", "size")
             .agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 AND refers_to IS NOT NULL").select("digest", "size", "refers_to"))
    marked = rows.join(first, ["digest", "size"], "left")
    again = F.col("refers_to").isNotNull() & ~F.col("id").eqNullSafe(F.col("refers_to"))
    marked = marked.select("id", "url", "body", F.when(again, F.col("refers_to")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, out, n = TaskContext.get().partitionId(), [], None, 0
        for batch in batches:
            for page_id, url, payload, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    uri = f"{path}/part-{part:06d}-{len(files):06d}.warc.gz"
                    out, n = FileWriter(uri), 0
                out.write(record(page_id, url, payload, refers, refers is not None))
                n += 1
                if out.size >= ARCHIVE_BYTES:
                    out.close()
                    files.append((uri, n))
                    out = None
        if out is not None:
            out.close()
            files.append((uri, n))
        if files:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in files], pa.string()),
                                              pa.array([k for _, k in files], pa.int64())], names=["uri", "records"])

    return materialize(marked.mapInArrow(task(write), "uri string, records long"), "warc-manifest")


def read_warc(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Records of the archives: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload (null for a revisit)."""
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                held, size = [], 0
                with open_file(uri) as f:
                    for m in members(f):
                        held.append(parse_record(m))
                        size += len(m)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.select("uri").repartition(n, "uri").mapInArrow(task(read), _COLUMNS)
