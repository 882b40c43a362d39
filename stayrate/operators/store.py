"""A store of fitted models under an explicit path.

A bundle holds the models of one fit, the frames they were fitted and tested on, and a
table of facts (metrics, names).  Its key is made from a fingerprint of the input files and
of the parameters, so another session, or another cluster on the same storage, finds
and scores with it without fitting; changed input or parameters give another key.

A bundle is written under a temporary name and renamed when it is whole, so a run that
dies leaves nothing that could be read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Part of every key: raise it when a change of the library changes fitted models.
VERSION = 4


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, old: str, new: str) -> bool:
    fs, p = _fs(spark, old)
    _, to = _fs(spark, new)
    fs.mkdirs(to.getParent())
    return fs.rename(p, to)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)


def fingerprint(*inputs: DataFrame) -> str:
    """A digest of the names, sizes and times of the files that the frames read; for frames
    without files, of their rows in any order."""
    out = []
    for df in inputs:
        spark, files = df.sparkSession, sorted(df.inputFiles())
        folders = sorted({f.rsplit("/", 1)[0] for f in files})
        wanted, seen = set(files), []
        for folder in folders:
            fs, p = _fs(spark, folder)
            seen += [(str(s.getPath().toString()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p) if s.isFile()]
        listed = [s for s in seen if s[0].split(":", 1)[-1].lstrip("/") in {w.split(":", 1)[-1].lstrip("/") for w in wanted}]
        if len(listed) < len(wanted) or not files:
            r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
            listed = [r["n"], str(r["h"])]
        out.append([df.schema.simpleString(), sorted(map(str, listed))])
    return hashlib.sha1(json.dumps(out).encode()).hexdigest()


class Bundle:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        meta = json.loads(read_text(spark, f"{path}/facts"))
        self.facts, self._kinds = meta["facts"], meta["kinds"]

    @property
    def models(self) -> list[str]:
        return list(self._kinds)

    def model(self, name: str):
        """One model, loaded from its folder."""
        where = f"{self.path}/models/{list(self._kinds).index(name)}"
        loader = _LOADERS.get(self._kinds[name])
        return loader(read_text(self.spark, where)) if loader else DefaultParamsReader.loadParamsInstance(where, self.spark.sparkContext)

    def frame(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/frames/{name}")


#: Readers of the library's own models by class name; they are kept as JSON.
_LOADERS: dict[str, Callable[[str], object]] = {}


def register_model(cls):
    """For classes with ``to_json`` and ``from_json``."""
    _LOADERS[cls.__name__] = cls.from_json
    return cls


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def key(self, name: str, inputs: list[DataFrame], params: Mapping) -> str:
        text = json.dumps([VERSION, name, fingerprint(*inputs), dict(params)], sort_keys=True)
        return f"{name}-{hashlib.sha1(text.encode()).hexdigest()[:20]}"

    def get(self, key: str) -> Bundle | None:
        return Bundle(self.spark, f"{self.path}/{key}") if exists(self.spark, f"{self.path}/{key}/facts/_SUCCESS") else None

    def put(self, key: str, models: Mapping[str, object], frames: Mapping[str, DataFrame], facts: Mapping) -> Bundle:
        tmp = f"{self.path}/_{key}-{uuid.uuid4().hex}"
        for k, (name, m) in enumerate(models.items()):
            if type(m).__name__ in _LOADERS:
                write_text(self.spark, m.to_json(), f"{tmp}/models/{k}")
            else:
                m.write().save(f"{tmp}/models/{k}")
        for name, df in frames.items():
            df.write.parquet(f"{tmp}/frames/{name}")
        write_text(self.spark, json.dumps({"facts": dict(facts), "kinds": {n: type(m).__name__ for n, m in models.items()}}), f"{tmp}/facts")
        if not exists(self.spark, f"{self.path}/{key}"):
            rename(self.spark, tmp, f"{self.path}/{key}")
        return self.get(key)

    def get_or_fit(self, key: str, fit: Callable[[], tuple[Mapping, Mapping, Mapping]]) -> Bundle:
        """The bundle of a key; ``fit`` gives (models, frames, facts) where there is none yet."""
        return self.get(key) or self.put(key, *fit())
