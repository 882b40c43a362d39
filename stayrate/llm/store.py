"""Files of the operators' own formats in the shared folder, and code shipping.

Everything goes to the folder that the cluster names in
``spark.checkpoint.dir``: a task writes a file under a temporary name and
renames it, so a task that runs again after a lost executor (or twice at the
same time) leaves one whole file.
"""

from __future__ import annotations

import ctypes
import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator
from hashlib import sha1

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.session import checkpoint_dir

_LIBC = ctypes.CDLL(None)
_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _split(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def shared_uri(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_file(uri: str, *parts: bytes) -> None:
    """Write a whole file or nothing."""
    fs, path = _split(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp, compression=None) as out:
        for p in parts:
            out.write(p)
    fs.move(tmp, path)


class FileWriter:
    """A file that appears under its name when it is closed."""

    def __init__(self, uri: str):
        self.fs, self.path = _split(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


def open_file(uri: str):
    """A readable, sequential binary stream."""
    fs, path = _split(uri)
    return fs.open_input_stream(path, compression=None)


def read_file(uri: str) -> bytes:
    with open_file(uri) as f:
        return f.read()


def materialize(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from it.

    ``batch_rows``: rows per Arrow batch while it is written, for tasks that hold
    much else (the session's setting comes back afterwards).
    """
    spark = df.sparkSession
    path = shared_uri(spark, name)
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", None
    if batch_rows:
        before = spark.conf.get(key)
        spark.conf.set(key, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders of intermediate files that nothing reads any more (of a table: its ``stored_at``)."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def task(fn: Callable) -> Callable:
    """A function on Arrow batches for ``mapInArrow`` whose worker gives freed memory back.

    Workers stay for later tasks, beside each other and the JVM: large buffers go
    to the system as they are freed, the rest when the task ends.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _lean_memory()
        try:
            yield from fn(batches)
        finally:
            _release_memory()
    return run


def _lean_memory() -> None:
    pa.set_memory_pool(pa.system_memory_pool())
    if hasattr(_LIBC, "mallopt"):
        _LIBC.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD, which else grows


def _release_memory() -> None:
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, *others: str) -> DataFrame:
    """``row`` (a struct of all columns), row_key (its hash), doc_id, text and other columns:
    the operators' names beside the row's own, whatever those are."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(*docs.columns).alias("row_key"),
                       F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *others)


def ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, wherever the driver found them."""
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for top, _, names in sorted(os.walk(_PACKAGE)):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(top, n)
                    z.writestr(zipfile.ZipInfo(os.path.relpath(p, os.path.dirname(_PACKAGE))), open(p, "rb").read())
    data = blob.getvalue()
    name = f"stayrate-{sha1(data).hexdigest()[:16]}.zip"
    sc = spark.sparkContext
    if any(str(x).endswith(name) for x in sc._python_includes):
        return
    uri = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    write_file(uri, data)
    sc.addPyFile(uri)
