"""Run a registered query in Spark and its oracle in DuckDB and compare.

Mirrors the driver's check: row count, column names and an order-insensitive
comparison of the values.  Used by the tests and by ``python -m
stayrate.plans.check [names...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def _rows(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda r: tuple(str(x) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from stayrate.plans import ORACLES, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLES:
        out["status"] = "no-oracle"
        return out
    con = con or duck(sf_dir)
    rel = con.sql(ORACLES[name])
    dcols = rel.columns
    drows = rel.fetchall()
    out["oracle_rows"] = len(drows)
    if sorted(cols) != sorted(dcols):
        out["status"] = "schema"
        out["detail"] = f"spark={cols} oracle={dcols}"
        return out
    order = [dcols.index(c) for c in cols]
    drows = [tuple(r[i] for i in order) for r in drows]
    a, b = _rows(srows), _rows(drows)
    if a == b:
        out["status"] = "match"
    else:
        out["status"] = "values"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["detail"] = str(diff)[:800]
    return out


def main(argv):
    from stayrate.plans import QUERIES
    from stayrate.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")] or sorted(QUERIES)
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "error", "detail": str(e)[:600]}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")


if __name__ == "__main__":
    main(sys.argv[1:])
