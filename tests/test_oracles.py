"""Every query with an oracle matches DuckDB on the same Parquet tables
(the driver's check, run here on sf0.001)."""

import pytest

from stayrate.plans import ORACLES
from stayrate.plans.check import compare

from conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, name, SMALL, duck_small)
    assert r["status"] == "match", r
