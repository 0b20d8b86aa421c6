"""The queries of this subpackage that SQL can express, against that SQL."""

import pytest
from oracle_harness import compare

from sieve.llm.oracle import ORACLE
from sieve.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    r = compare(spark, QUERIES[name], ORACLE[name], "/root/testdata/sf0.001")
    assert r["cols_ok"] and r["values_ok"] and r["spark_rows"], r
