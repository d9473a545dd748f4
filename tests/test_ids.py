"""Ids that are missing, written in two ways, or no numbers: operators, report and oracle agree."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

import fixtures as fx
from cohortkit.plans import oracle
from cohortkit.plans.registry import registry
from cohortkit.plans.weekly import WeeklyKpi
from cohortkit.session import configure
from oracle_compare import same_rows

T = dt.datetime
ROWS = [
    # one order and lines without an order id: not a repeat shopper
    fx.line("40", 4001, T(2024, 1, 9, 10)), fx.line("40", None, T(2024, 1, 9, 10)), fx.line("40", None, T(2024, 1, 10, 10)),
    # only lines without an order id
    fx.line("43", None, T(2024, 1, 9, 10)),
    # one key in two spellings: retained twice, only one of them bought this year
    fx.line("7", 4101, T(2023, 5, 1)), fx.line("07", 4102, T(2023, 6, 1)), fx.line("7", 4103, T(2024, 1, 9, 11)),
    # reactivated in two spellings, one of them back; the other bought at two distributors
    fx.line("42", 4201, T(2021, 5, 1)), fx.line("042", 4202, T(2021, 6, 1)), fx.line("042", 4203, T(2021, 6, 2)),
    fx.line("42", 4204, T(2024, 1, 9, 12)),
    # a repeat shopper only if the spellings were one id
    fx.line("44", 4401, T(2024, 1, 9)), fx.line("044", 4402, T(2024, 1, 10)),
    # early in one spelling, retained in the other: not reactivated
    fx.line("45", 4501, T(2021, 5, 1)), fx.line("045", 4502, T(2023, 5, 1)),
]
MEMBERS = [("07", "BUILDING", T(2023, 1, 1)), ("7", "BUILDING", T(2022, 1, 1)), ("046", "BUILDING", T(2024, 1, 9)),
           ("46", "BUILDING", T(2024, 1, 10))]
KEYS = ("ytd_repeat", "repeat_having", "retain_base", "reactivate_base", "not_retained", "not_reactivated", "never_purchased_base",
        "new_member_base", "recall_counts", "member_base_summary", "segment_summary", "segmented_lines", "join_flag", "join_two_key",
        "purchase_rank", "first_purchase", "recency_buckets", "kpi_rollup", "recency_rollup", "weekly_kpi")


@pytest.fixture(scope="module")
def tables(spark):
    return fx.spark_tables(spark, fx.ORDERS + ROWS, fx.MEMBERS + MEMBERS)


@pytest.fixture(scope="module")
def duck():
    return fx.duck_tables(fx.ORDERS + ROWS, fx.MEMBERS + MEMBERS)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(key, tables, duck):
    q = registry()[key]
    df = q.on_tables(tables, fx.PARAMS)
    rel = duck.sql(oracle.query(fx.PARAMS, q.oracle_select, mapping=False))
    assert same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall()) == "match"


def test_operators_and_report_count_the_same(tables):
    found = lambda key: registry()[key].on_tables(tables, fx.PARAMS)
    recall = {r.member_type: r.still_need_to_recall for r in found("recall_counts").collect()}
    from cohortkit.functions import labels as L

    # the recall counts are of ids, the sets also hold rows without one
    known = lambda key: found(key).where("crm_member_id IS NOT NULL").select("crm_member_id").distinct().count()
    assert recall[L.RETAINED] == known("not_retained")
    assert recall[L.REACTIVATED] == known("not_reactivated")
    repeat = {r.crm_member_id: (r.ytd_repeat, r.ytd_repeat_orders) for r in found("ytd_repeat").collect()}
    assert repeat["40"] == repeat["43"] == repeat["44"] == repeat["044"] == (0, 0)
    rolled = {r.member_type: r for r in found("kpi_rollup").collect()}[L.YTD_REPEAT]
    assert rolled.member_shopper == sum(r for r, _ in repeat.values())


NO_MEMBER = [
    # lines without an id in the early window (two distributors), the retain window and paid this year
    fx.line(None, 6001, T(2021, 5, 1)), fx.line(None, 6002, T(2021, 5, 1), dist="LBR"), fx.line(None, 6003, T(2021, 6, 1)),
    fx.line(None, 6004, T(2021, 5, 1), dist="BUILDING 2"), fx.line(None, 6005, T(2023, 5, 1)), fx.line(None, 6006, T(2024, 1, 9)),
]


@pytest.mark.parametrize("pattern", ["BUILDING", "BUILD%", "%"])
def test_lines_without_a_member_stay_in_the_anti_joins(spark, pattern):
    orders, p = fx.ORDERS + ROWS + NO_MEMBER, fx.PARAMS.replace(distributor=pattern)
    tables, duck = fx.spark_tables(spark, orders, fx.MEMBERS + MEMBERS), fx.duck_tables(orders, fx.MEMBERS + MEMBERS)
    wide = pattern != "BUILDING"
    expected = {"not_retained": 1, "reactivate_base": 1 + wide, "not_reactivated": 1 + wide}
    for key, n in expected.items():
        q = registry()[key]
        df = q.on_tables(tables, p)
        rows = [tuple(r) for r in df.collect()]
        assert sum(r[0] is None for r in rows) == n, key
        rel = duck.sql(oracle.query(p, q.oracle_select, mapping=False))
        assert same_rows(df.columns, rows, rel.columns, rel.fetchall()) == "match", key


def test_an_id_that_is_no_number_raises_and_never_turns_non_member(spark):
    tables = fx.spark_tables(spark, fx.ORDERS + [fx.line("C-100", 5001, T(2024, 1, 9, 10), 1.0, "500.00")])
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        configure(spark)
        with pytest.raises(PySparkException):
            WeeklyKpi(tables, fx.PARAMS).report.collect()
        # even without the check the line stays a member's
        spark.conf.set("spark.sql.ansi.enabled", "false")
        grain = WeeklyKpi(tables, fx.PARAMS, "none").order_grain.where("crm_member_id = 'C-100'").collect()
        from cohortkit.functions import labels as L

        assert [r.seg_v1 for r in grain] == [L.SEGMENT_CODES[L.YTD_SHOPPER]]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
