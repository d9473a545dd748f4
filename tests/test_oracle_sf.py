"""Every registered query against its DuckDB oracle on the driver's tables."""

import os

import pytest

from cohortkit.plans.registry import oracle_sql, queries
from oracle_compare import compare, duck

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")


@pytest.fixture(scope="module")
def con_small():
    return duck(SMALL)


@needs_data
@pytest.mark.parametrize("key", sorted(queries()))
def test_key_matches_oracle_sf0001(spark, key, con_small):
    res = compare(spark, key, SMALL, queries(), oracle_sql(), con_small)
    assert res["status"] in ("match", "rows-only"), res


@needs_data
@pytest.mark.parametrize("key", ["weekly_kpi", "segmented_lines", "recency_buckets", "purchase_rank"])
def test_flagship_matches_oracle_sf001(spark, key):
    res = compare(spark, key, MEDIUM, queries(), oracle_sql(), duck(MEDIUM))
    assert res["status"] == "match", res


@needs_data
def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 15
    assert df.columns == ["member_type", "ttl_sales", "traffic", "registration_rate", "member_base",
                          "CR", "member_shopper", "member_frequency", "member_atv", "member_sales",
                          "still_need_to_recall"]
    # every key of the library has its SQL (the corpus operators, where present, have their own test)
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@needs_data
def test_anti_joins_keep_rows_without_a_member(spark):
    found = {key: queries()[key](spark, MEDIUM).count() for key in ("reactivate_base", "not_retained", "not_reactivated")}
    assert found == {"reactivate_base": 620, "not_retained": 179, "not_reactivated": 521}
