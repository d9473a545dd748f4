
import os

import pytest

from cohortkit.operators import cohorts
from cohortkit.params import KpiParams
from cohortkit.plans import member_profile as member_profile_module
from cohortkit.plans.member_profile import member_facts, member_profile
from cohortkit.plans.registry import queries
from cohortkit.plans.weekly import WeeklyKpi
from cohortkit.sources import tpch_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
P = KpiParams()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return tpch_tables(spark, SF)


def test_anti_joins_are_left_anti(tables):
    for df in (cohorts.never_purchased_base(tables.member_orders, tables.members, P),
               cohorts.other_channel_base(tables.member_orders, tables.members, P)):
        text = plan(df)
        assert "LeftAnti" in text
        assert "LeftOuter" not in text


def test_cohorts_of_the_fact_alone_read_it_once(tables):
    for df in (cohorts.reactivate_base(tables.member_orders, P), cohorts.not_reactivated(tables.member_orders, P),
               cohorts.not_retained(tables.member_orders, P)):
        assert plan(df).split("== Initial Plan ==")[0].count("lineitem.parquet") == 1


def test_lapsed_reads_keep_their_date_bound(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(cohorts.reactivate_base(tables.member_orders, P)).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in text.splitlines() if "FileScan" in line and "orders.parquet" in line)
    assert f"LessThan(o_orderdate,{P.ytd_start}" in pushed
    assert text.count("Window ") == 1


def test_line_join_reads_three_profile_columns_and_a_flag(tables):
    w = WeeklyKpi(tables, P)
    text = plan(w.order_grain)
    # the facts both codes come from; no window, as every id is written as its key
    assert "ReadSchema: struct<member_key:bigint,flags:int,recency_start:int,first_other:boolean>" in text
    assert "Window" not in text
    folder = w.profile.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.isdir(folder)
    w.release()
    assert not os.path.exists(folder)


def test_traffic_days_reach_the_scan(spark, tables):
    for key in ("traffic_total", "registration_rate"):
        text = plan(queries()[key](spark, SF))
        assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text, key


def test_two_key_join_leaves_non_members_out(spark):
    text = plan(queries()["join_two_key"](spark, SF))
    assert "isnotnull(crm_member_id" in text or "% 10) = 0)" in text
    joined = text.split("Union")[1]
    assert "Join" in joined


def test_member_profile_is_one_hash_aggregate(tables):
    text = plan(member_facts(tables.member_orders, tables.members, P))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    # the YTD (member, order) step and the facts
    assert text.count("Exchange hashpartitioning") == 2 and "Window" not in text
    assert "Exchange" not in plan(member_profile(tables.member_orders, tables.members, P))


def test_only_keys_spelled_twice_are_gathered(spark):
    import fixtures as fx

    ids = [fx.line(i, n, fx.T(2024, 1, 9)) for n, i in enumerate(("7", "07", "8", "09", "10"))]
    t = fx.spark_tables(spark, ids)
    profile = member_profile(t.member_orders, t.members, fx.PARAMS)
    text = plan(profile).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "LeftAnti" in text and text.count("Window ") == 1
    found = {r.member_id: r.first_of_key for r in profile.collect()}
    assert {k for k in found if found[k]} >= {"07", "8", "09", "10"} and not found["7"]
    same = {tuple(r) for r in member_profile(t.member_orders, t.members, fx.PARAMS, "none").collect()}
    assert same == {tuple(r) for r in profile.collect()}
    # too many odd keys to broadcast: the same rows by shuffled joins
    old, member_profile_module.MAX_BROADCAST_KEYS = member_profile_module.MAX_BROADCAST_KEYS, 0
    try:
        assert same == {tuple(r) for r in member_profile(t.member_orders, t.members, fx.PARAMS).collect()}
    finally:
        member_profile_module.MAX_BROADCAST_KEYS = old


def test_no_python_no_cartesian_anywhere(spark):
    for key, fn in queries().items():
        text = plan(fn(spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas",
                    "BroadcastNestedLoopJoin"):
            assert bad not in text, (key, bad)


def test_period_filters_reach_the_scan(tables):
    w = WeeklyKpi(tables, P)
    text = plan(w.order_grain)
    # the period bound on the paid date is pushed into the orders scan
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    # columns the report does not read stay out of the lineitem scan
    assert "l_tax" not in text and "l_discount" not in text


def test_non_member_lines_cross_the_join_as_one_row(tables):
    # all lines without a member collapse into one (NULL, NULL) row before the
    # member join, so their NULL key cannot pile up in one join partition
    from pyspark.sql import functions as F

    from cohortkit.functions.labels import NON_MEMBER, NON_MEMBER_V2, SEGMENT_CODES

    grain = WeeklyKpi(tables, P, "none").order_grain
    rows = grain.where(F.col("crm_member_id").isNull()).collect()
    assert len(rows) == 1
    assert rows[0]["seg_v1"] == SEGMENT_CODES[NON_MEMBER]
    assert rows[0]["seg_v2"] == SEGMENT_CODES[NON_MEMBER_V2]
    assert rows[0]["original_order_id"] is None


def test_rank_numbers_per_member_and_day(spark):
    text = plan(queries()["purchase_rank"](spark, SF))
    # the numbering window is partitioned by member and paid day, not member alone
    assert "__bucket" in text and "rangepartitioning" not in text
    # numbered once: the offsets come from counts, not from numbered rows
    assert text.split("== Initial Plan ==")[0].count("row_number()") == 1


def test_period_is_read_once(tables):
    # with the profile checkpointed, the order grain's plan holds only the
    # period's own scans: members and non-members come from one read
    w = WeeklyKpi(tables, P, "checkpoint")
    text = plan(w.order_grain)
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") == 1


def test_sort_aggregate_only_where_strings_are_returned(spark):
    # the first-purchase row itself needs a struct min (strings); every other
    # query, the first-purchase cohorts included, aggregates by hash
    for key, fn in queries().items():
        text = plan(fn(spark, SF))
        if key == "first_purchase":
            continue
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text, key
