import importlib.util
import os

from conftest import ROOT


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 150
    assert len(df.columns) == 11 + 25 + 21 + 5 + 6


def test_every_oracle_has_a_query():
    mod = _entry()
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert len(mod.queries()) >= 100
