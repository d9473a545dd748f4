"""Member cohorts of the period (A3-A8) and the lapsed cohorts at its end.

Each "left join, then keep rows whose right side is NULL" of the report is
written as a ``left_anti`` join against a de-duplicated key set: Catalyst
keeps the left-join form as an outer join plus filter, while an anti join
neither fans out nor carries the right side's columns.  The left side is reduced to
its distinct output rows *before* the anti join (an anti join only removes
rows, so the result is the same): the reduction combines map-side, and a
member with a huge history reaches the join as a few rows, not as its lines.
Cohorts whose parts come from the order fact alone (A6, A14, A15) read it once:
the parts travel as bits of one member aggregate.  There an anti join keeps
lines without a member id, as its key test is never true for them.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import in_range, is_true, member_key, upper_like
from cohortkit.operators.purchases import (
    clean_effective_lines,
    effective_lines,
    first_code_day,
    first_code_other,
    first_codes,
)
from cohortkit.params import KpiParams


def _keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct integer join keys of a member set."""
    return df.select(member_key(F.col(col)).alias("__key")).where(F.col("__key").isNotNull()).distinct()


def _anti(left: DataFrame, left_col: str, keys: DataFrame) -> DataFrame:
    return left.join(keys, member_key(F.col(left_col)) == F.col("__key"), "left_anti")


def new_member_base(members: DataFrame, p: KpiParams) -> DataFrame:
    """A3: members who joined in the period through a channel matching the pattern."""
    return (members
            .where(in_range(F.to_date("join_time"), p.start, p.end)
                   & upper_like(F.col("eff_reg_channel"), p.distributor))
            .select("member_detail_id", "eff_reg_channel")
            .distinct())


def never_purchased_base(orders: DataFrame, members: DataFrame, p: KpiParams) -> DataFrame:
    """A4: members who joined before the period and never bought before it."""
    bought = _keys(clean_effective_lines(orders, p).where(F.col("date_id") < F.lit(p.start)),
                   "crm_member_id")
    joined = (members.where((F.to_date("join_time") < F.lit(p.start))
                            & upper_like(F.col("eff_reg_channel"), p.distributor))
              .select("member_detail_id").distinct())
    return _anti(joined, "member_detail_id", bought)


def retain_base(orders: DataFrame, p: KpiParams) -> DataFrame:
    """A5: (member, distributor) with an effective purchase in [retain_start, ytd_start)."""
    return (clean_effective_lines(orders, p)
            .where(in_range(F.col("date_id"), p.retain_start, p.ytd_start))
            .select("crm_member_id", "distributor_name")
            .distinct())


_EARLY, _RETAINED, _PAID_YTD = 1, 2, 4


def _member_bits(orders: DataFrame, p: KpiParams, wanted: int, *group: str) -> DataFrame:
    """One read of the fact: per (member id, ``group``) what its effective lines prove,
    as bits.  Members with a long history come down to a few rows map-side.

    Only lines that prove a ``wanted`` bit are read, so a reader that asks for
    date bits keeps the date bound of its scan.  Lines without a member come
    down to one row per ``group`` like a member's; no purchase is theirs, so
    they never get ``_PAID_YTD``.
    """
    day, paid, known = F.col("date_id"), F.col("order_paid_time"), F.col("crm_member_id").isNotNull()
    clean = is_true(F.col("distributor_name") != p.excluded_distributor)
    proof = {_EARLY: clean & (day < F.lit(p.retain_start)),
             _RETAINED: clean & in_range(day, p.retain_start, p.ytd_start),
             _PAID_YTD: known & is_true(in_range(paid, p.ytd_start, p.end))}
    asked = {bit: cond for bit, cond in proof.items() if wanted & bit}
    lines = effective_lines(orders, p).where(reduce(or_, asked.values()))
    if not wanted & _PAID_YTD:
        lines = lines.where(day < F.lit(p.ytd_start if wanted & _RETAINED else p.retain_start))
    bits = reduce(add, (F.when(cond, F.lit(bit)).otherwise(F.lit(0)) for bit, cond in asked.items()))
    return lines.groupBy("crm_member_id", *group).agg(F.bit_or(bits).alias("bits"))


def _bit(name: str, value: int):
    return F.col(name).bitwiseAND(F.lit(value)) != 0


def _reactivation(orders: DataFrame, p: KpiParams, wanted: int) -> DataFrame:
    """(member id, distributor) with an early purchase, the integer key not retained.

    A missing id equals no key, so its rows pass; each is a window
    partition of its own (``__apart``) and sees its own bits only.
    """
    rows = _member_bits(orders, p, wanted, "distributor_name").withColumns({
        "__key": member_key(F.col("crm_member_id")),
        "__apart": F.when(F.col("crm_member_id").isNull(), F.col("distributor_name"))})
    of_key = {"of_key": F.bit_or("bits").over(Window.partitionBy("__key", "__apart"))}
    if wanted & _PAID_YTD:  # what is paid counts for the id as written, at all distributors
        of_key["of_id"] = F.bit_or("bits").over(Window.partitionBy("__key", "__apart", "crm_member_id"))
    rows = rows.withColumns(of_key)
    return rows.where(_bit("bits", _EARLY) & (F.col("crm_member_id").isNull() | ~_bit("of_key", _RETAINED)))


def reactivate_base(orders: DataFrame, p: KpiParams) -> DataFrame:
    """(member, distributor) who bought before retain_start and are not retained."""
    return _reactivation(orders, p, _EARLY | _RETAINED).select("crm_member_id", "distributor_name")


def ytd_first_purchase_base(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Members whose first purchase ever falls in [ytd_start, start)."""
    first = first_codes(orders, p)  # one row per member
    return (first.where(in_range(first_code_day(F.col("first_code")), p.ytd_start, p.start))
            .select("crm_member_id"))


def other_channel_base(orders: DataFrame, members: DataFrame, p: KpiParams) -> DataFrame:
    """First purchase in the period, registered through a channel not matching
    the pattern, and not a new member of the period."""
    code = F.col("first_code")
    first = first_codes(orders, p).where(
        in_range(first_code_day(code), p.start, p.end) & first_code_other(code))
    new = _keys(new_member_base(members, p), "member_detail_id")
    # first codes are one row per member already
    return _anti(first.select("crm_member_id"), "crm_member_id", new)


def not_retained(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Retained-window buyers with no purchase paid in [ytd_start, end)."""
    rows = _member_bits(orders, p, _RETAINED | _PAID_YTD)
    return rows.where(_bit("bits", _RETAINED) & ~_bit("bits", _PAID_YTD)).select("crm_member_id")


def not_reactivated(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Reactivation candidates with no purchase paid in [ytd_start, end)."""
    rows = _reactivation(orders, p, _EARLY | _RETAINED | _PAID_YTD)
    return rows.where(~_bit("of_id", _PAID_YTD)).select("crm_member_id", "distributor_name")
