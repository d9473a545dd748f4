"""Edge rows of FIXTURES.md section 3 through both engines, plus pinned semantics."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from cohortkit.functions import labels as L
from cohortkit.plans import oracle
from cohortkit.plans.registry import registry
from cohortkit.plans.weekly import WeeklyKpi
from oracle_compare import same_rows

PATTERN_ALL = fx.PARAMS.replace(distributor="%")
FLAGSHIP_KEYS = ("weekly_kpi", "segmented_lines", "recency_buckets", "member_base_summary",
                 "recall_counts", "ytd_repeat", "purchase_rank", "never_purchased_base",
                 "other_channel_base", "not_retained", "not_reactivated", "reactivate_base")


@pytest.fixture(scope="module")
def tables(spark):
    return fx.spark_tables(spark)


@pytest.fixture(scope="module")
def duck():
    return fx.duck_tables()


def _check(key, tables, duck, params):
    q = registry()[key]
    df = q.on_tables(tables, params)
    rel = duck.sql(oracle.query(params, q.oracle_select, mapping=False))
    status = same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
    assert status == "match", f"{key}: {status}"


@pytest.mark.parametrize("key", sorted(k for k, q in registry().items() if q.oracle_select))
def test_every_key_matches_oracle_on_edge_rows(key, tables, duck):
    _check(key, tables, duck, fx.PARAMS)


@pytest.mark.parametrize("key", FLAGSHIP_KEYS)
def test_pattern_matching_every_distributor(key, tables, duck):
    # with '%' the excluded distributor's lines enter the purchase history
    # (T11) and no channel is "other" (T8)
    _check(key, tables, duck, PATTERN_ALL)


def _report(tables, params=fx.PARAMS):
    return {r["member_type"]: r.asDict() for r in WeeklyKpi(tables, params).report.collect()}


def test_recency_bucket_edges_to_the_second(tables):
    rows = registry()["recency_buckets"].on_tables(tables, fx.PARAMS).where(F.col("anchor") == "start")
    got = {r["crm_member_id"]: r["recency_bucket"] for r in rows.collect()}
    assert got["10"] == L.RECENCY_0_90        # exactly start - 90 days
    assert got["11"] == L.RECENCY_90_180      # one second earlier
    assert got["12"] == L.RECENCY_90_180      # exactly start - 180 days
    assert got["13"] == L.RECENCY_180_270
    assert got["14"] == L.RECENCY_180_270     # exactly start - 270 days
    assert got["15"] == L.RECENCY_270_360     # exactly start - 360 days
    assert got["16"] == L.RECENCY_360_PLUS
    assert "17" not in got                    # paid exactly at the anchor
    assert "18" not in got                    # only a purchase without paid time
    assert "1" not in got                     # first purchase after the anchor


def test_first_purchase_ties_and_channels(tables):
    first = {r["crm_member_id"]: r for r in
             registry()["first_purchase"].on_tables(tables, fx.PARAMS).collect()}
    assert first["19"]["original_order_id"] == 1902   # matching channel wins the tie
    assert first["18"]["original_order_id"] == 1802   # NULL paid time sorts last
    other = {r["crm_member_id"] for r in
             registry()["other_channel_base"].on_tables(tables, fx.PARAMS).collect()}
    assert other == {"5"}                              # mixed case upper-cased; NULL channel drops
    rank = {(r["crm_member_id"], r["original_order_id"]): r["rk"] for r in
            registry()["purchase_rank"].on_tables(tables, fx.PARAMS).collect()}
    assert rank[("18", 1801)] == 2 and rank[("18", 1802)] == 1
    assert rank[("19", 1902)] == 1 and rank[("19", 1901)] == 2


def test_cohorts(tables):
    never = {r[0] for r in registry()["never_purchased_base"].on_tables(tables, fx.PARAMS).collect()}
    assert never == {"2", "8", "21"}  # 8 through the upper-cased channel; 21 bought only at LBR
    new = registry()["new_member_base"].on_tables(tables, fx.PARAMS).collect()
    assert {r[0] for r in new} == {"1", "9"}
    rep = {r["crm_member_id"]: r for r in registry()["ytd_repeat"].on_tables(tables, fx.PARAMS).collect()}
    assert rep["6"]["ytd_repeat"] == 1 and rep["6"]["ytd_repeat_orders"] == 2
    assert rep["3"]["ytd_repeat"] == 0 and rep["3"]["ytd_repeat_orders"] == 0
    assert rep["25"]["ytd_repeat_member_sales"] == -50.0
    # 6: 70 + 80 - 20 (return with positive amount), zero-quantity line ignored
    assert rep["6"]["ytd_repeat_member_sales"] == 130.0


def test_report_rows_and_totals(tables):
    rep = _report(tables)
    assert len(rep) == 15
    base_rows = (L.NEVER_PURCHASED, L.RETAINED, L.REACTIVATED, L.YTD_SHOPPER, L.OTHER_CHANNEL)
    for col in ("member_base", "member_shopper"):
        assert rep[L.EXISTING][col] == sum(rep[k][col] or 0 for k in base_rows)
        assert rep[L.TTL][col] == sum(rep[k][col] or 0 for k in (*base_rows, L.NEW_MEMBER, L.NON_MEMBER))
    assert rep[L.NEW_MEMBER]["traffic"] == 175.0       # agg type, distributor and end date filtered
    assert rep[L.NEW_MEMBER]["registration_rate"] == round(2 / 175, 4)
    assert all(rep[k]["traffic"] is None for k in rep if k != L.NEW_MEMBER)
    assert rep[L.NON_MEMBER]["ttl_sales"] == 0.0         # 12.50 sale, 12.50 return
    assert rep[L.NON_MEMBER]["member_sales"] == 0.0 and rep[L.NON_MEMBER]["member_shopper"] == 0
    assert rep[L.YTD_REPEAT]["member_shopper"] == 4
    assert rep[L.RETAINED]["still_need_to_recall"] is not None
    assert rep[L.NEW_MEMBER]["still_need_to_recall"] is None


def test_no_new_member_drops_the_non_member_row(spark):
    members = [m for m in fx.MEMBERS if m[0] not in ("1", "9")]
    tables = fx.spark_tables(spark, members=members)
    duck = fx.duck_tables(members=members)
    rep = _report(tables)
    assert L.NON_MEMBER not in rep and len(rep) == 14
    assert rep[L.NEW_MEMBER]["member_base"] == 0
    _check("weekly_kpi", tables, duck, fx.PARAMS)


def test_no_traffic_gives_null_rate(spark):
    tables = fx.spark_tables(spark, traffic=[])
    rep = _report(tables)
    assert rep[L.NEW_MEMBER]["traffic"] is None
    assert rep[L.NEW_MEMBER]["registration_rate"] is None
    zero = fx.spark_tables(spark, traffic=[("STORE", dt.date(2024, 1, 9), "BUILDING", 0.0)])
    rep0 = _report(zero)
    assert rep0[L.NEW_MEMBER]["traffic"] == 0.0 and rep0[L.NEW_MEMBER]["registration_rate"] is None


def test_segment_without_lines_has_null_sales_and_zero_ratios(spark):
    # no period lines at all: every segment row has NULL sales and 0 ratios
    orders = [r for r in fx.ORDERS if not (fx.PARAMS.start <= r[7] < fx.PARAMS.end)]
    rep = _report(fx.spark_tables(spark, orders=orders))
    row = rep[L.RETAINED]
    assert row["ttl_sales"] is None and row["member_shopper"] is None
    assert row["CR"] == 0.0 and row["member_frequency"] == 0.0 and row["member_atv"] == 0.0


def test_integer_member_key_matches_leading_zero_ids(spark):
    # '7' and '07' are one member for every join of the reference: a line of
    # one spelling matches the sets of the other, and is not doubled (SURVEY
    # T18); counts take each spelling on its own (tests/test_ids.py)
    paid = dt.datetime(2024, 1, 9, 9)
    orders = fx.ORDERS + [fx.line("7", 701, dt.datetime(2023, 7, 1)), fx.line("07", 702, paid, 1.0, "11.00")]
    tables = fx.spark_tables(spark, orders=orders)
    w = WeeklyKpi(tables, fx.PARAMS)
    prof = w.profile.where(F.col("member_key") == 7).collect()
    assert sorted((r["member_id"], r["is_retain"], r["key_retain"]) for r in prof) == [("07", False, True), ("7", True, True)]
    assert sum(r["first_of_key"] for r in prof) == 1
    lines = w.segmented_lines.where(F.col("original_order_id") == 702).collect()
    assert len(lines) == 1 and lines[0]["member_segment"] == L.RETAINED
    assert lines[0]["order_rrp_amt"] == Decimal("11.00")


def test_no_non_member_lines(spark):
    orders = [r for r in fx.ORDERS if r[0] is not None]
    tables = fx.spark_tables(spark, orders=orders)
    rep = _report(tables)
    assert rep[L.NON_MEMBER]["ttl_sales"] is None and rep[L.NON_MEMBER]["member_shopper"] is None
    _check("weekly_kpi", tables, fx.duck_tables(orders=orders), fx.PARAMS)
    _check("segment_summary", tables, fx.duck_tables(orders=orders), fx.PARAMS)


@pytest.mark.parametrize("key", ["recency_buckets", "recency_start_90_180", "recency_end_360_plus",
                                 "filter_day_offset", "flag_max_having", "weekly_kpi"])
def test_other_recency_edges(key, tables, duck):
    # the edges are parameters; labels keep their fixed text
    _check(key, tables, duck, fx.PARAMS.replace(recency_edges=(30, 60, 120, 200)))


def test_session_time_zone_does_not_matter(spark, tables, duck):
    # paid times are TIMESTAMP_NTZ and every bound is a DATE: no time zone enters
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for key in ("weekly_kpi", "purchase_rank", "recency_buckets"):
            _check(key, tables, duck, fx.PARAMS)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("mode", ["checkpoint", "table", "persist", "none"])
def test_report_in_every_materialisation_mode(spark, tables, duck, mode):
    rel = duck.sql(oracle.query(fx.PARAMS, registry()["weekly_kpi"].oracle_select, mapping=False))
    df = WeeklyKpi(tables, fx.PARAMS, mode).report
    assert same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) == "match"
