"""Registered queries against their DuckDB oracles on the smallest tables."""

import pytest

import __spark_entry__ as E
from quantspark.plans.oracle import compare

SF = "/root/testdata/sf0.001"
FAST = ["a1", "d2", "p3", "b18", "b9", "e1", "d5", "w23", "p23", "v1", "v3", "v5", "e2", "e5", "b10", "b16", "b20"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["columns_match"] and r["values_match"], r


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "realized_vol_24h" in df.columns
