"""Spark session helpers.

On a cluster the session is created by the platform; the library only reads
its settings.  ``get_spark`` is for tests, benchmarks and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "stayrate", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on, UI off and UTC time; on a local
    master a temporary checkpoint folder, if none is configured."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("STAYRATE_DRIVER_MEMORY", "8g"),
    }
    if (master or "").startswith("local"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="stayrate-ckpt-")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Raises when it is unset: a machine-local folder would lose its files with
    the machine, so only a local harness (tests, bench) may choose one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used before iterative loops (model bake-offs, K-Means restarts) so a lost
    executor recomputes from the checkpoint, not from the raw scans.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
