"""The queries with SQL against DuckDB on the driver's tables."""

import os

import pytest

from cohortkit.llm.queries import oracle_sql, queries
from oracle_compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_key_matches_oracle(spark, key):
    res = compare(spark, key, SMALL, queries(), oracle_sql(), duck(SMALL))
    assert res["status"] == "match", res


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
