"""Every registered query against its DuckDB oracle on the smallest tables.

Set SIEVE_ORACLE_SF to another folder (e.g. /root/testdata/sf0.01) for the
full-size check the driver runs.
"""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck

SF = os.environ.get("SIEVE_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    fn = E.queries()[name]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert fn(spark, SF).count() >= 0
        return
    r = compare(spark, fn, sql, SF, con)
    assert r["cols_ok"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
