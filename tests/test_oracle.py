"""Every query of the analytic part against its DuckDB SQL twin on the smallest test data."""

import os

import pytest

import oracle_check
import __spark_entry__ as E
from servelens import registry

SF = os.environ.get("SERVELENS_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


def test_every_query_has_sql():
    missing = [k for k in KEYS if k not in registry.oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = oracle_check.compare(spark, con, key, registry.queries()[key], registry.oracle_sql()[key], SF)
    assert r["cols"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["close"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_cpi" in df.columns
