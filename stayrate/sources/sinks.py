"""Sinks: persist result frames (model tables, segment summaries, scores).

``write_versioned`` keeps every run: rows go to a folder of their own, then the version is
committed by creating its numbered entry, which either happens whole or not at all.
Readers see the last committed version, or any earlier one; a run that dies before
the commit is never seen.  ``write_batch`` keeps a stream's table the same way, an entry per batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

LOG = "_versions"


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> str:
    """Write ``df`` to ``path``; partitioned output (e.g. by ``as_of``) lets
    later reads prune whole folders.  Returns the path."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, oldest first."""
    fs, log = _fs(spark, f"{path.rstrip('/')}/{LOG}")
    if not fs.exists(log):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(log) if s.getPath().getName().isdigit())


def _folder(spark: SparkSession, path: str, version: int) -> str:
    return spark.read.text(f"{path.rstrip('/')}/{LOG}/{version:09d}").first()["value"]


def commit_as(spark: SparkSession, path: str, folder: str, number: int) -> bool:
    """Make ``folder`` (under ``path``) version ``number``, unless there is one."""
    path = path.rstrip("/")
    fs, entry = _fs(spark, f"{path}/{LOG}/{number:09d}")
    if fs.exists(entry):
        return False
    _, tmp = _fs(spark, f"{path}/{LOG}/.{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(f"{folder}\n".encode()))
    out.close()
    if not fs.exists(entry) and fs.rename(tmp, entry):
        return True
    fs.delete(tmp, False)
    return False


def commit(spark: SparkSession, path: str, folder: str) -> int:
    """Make ``folder`` the next version; of writers that meet, each gets a number of its own."""
    number = (versions(spark, path) or [0])[-1] + 1
    while not commit_as(spark, path, folder, number):
        number += 1
    return number


def write_versioned(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None) -> int:
    """Write ``df`` as the next version of the table at ``path``; returns its number."""
    folder = f"rows-{uuid.uuid4().hex}"
    write_results(df, f"{path.rstrip('/')}/{folder}", fmt, "errorifexists", partition_by)
    return commit(df.sparkSession, path, folder)


def read_versioned(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The last committed version of a table, or a given one."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no committed version {version or ''} at {path}")
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{_folder(spark, path, version or known[-1])}")


def write_batch(df: DataFrame, path: str, batch: int, partition_by: Sequence[str] | None = None) -> bool:
    """Add the rows of a numbered batch to the table at ``path``, once: a batch that was committed
    before is left as it is (what a restarted stream asks for again)."""
    spark = df.sparkSession
    if batch in versions(spark, path):
        return False
    folder = f"rows-{uuid.uuid4().hex}"
    write_results(df, f"{path.rstrip('/')}/{folder}", "parquet", "errorifexists", partition_by)
    return commit_as(spark, path, folder, batch)


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    path = path.rstrip("/")
    out = spark.createDataFrame([], schema)
    folders = [f"{path}/{r['value']}" for r in spark.read.text(f"{path}/{LOG}").collect()] if versions(spark, path) else []
    for f in folders:
        out = out.unionByName(spark.read.schema(schema).parquet(f))
    return out
