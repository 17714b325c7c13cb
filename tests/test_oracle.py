"""The correctness gate, locally: every query with a DuckDB twin must give
the same rows (count, column names, order-insensitive value hash) on the
sf0.001 tables. ``python tests/oracle_harness.py`` runs it at sf0.01."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from talewright.plans.catalog import QUERIES
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin():
    missing = sorted(set(QUERIES) - set(oracle_sql()))
    assert missing == []


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["block", "prompt", "response"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_oracle(spark, con, key):
    r = compare(spark, con, key, SF, queries()[key], oracle_sql()[key])
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r
