"""Recency of members at an anchor date (A9-A13 at the start, A16-A19 at the end).

The reference builds each bucket with its own two-flag ``MAX(CASE ..)``
aggregate over the purchase history.  The buckets partition the members that
bought before the anchor by their latest such purchase, so one
``max(paid_time)`` aggregate decides all five (``recency_buckets``).  The
per-bucket operators are kept for users who want one bucket with its flags.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import day_offset, in_range
from cohortkit.functions.labels import CODE_LABELS, RECENCY_CODES
from cohortkit.operators.purchases import purchase_lines
from cohortkit.params import KpiParams


def bucket_code(last_paid: str, anchor: dt.date, edges) -> Column:
    """Code of the recency bucket of a member whose latest purchase before
    ``anchor`` is in column ``last_paid`` (NULL when there was none)."""
    whens = " ".join(f"WHEN {last_paid} >= DATE'{anchor - dt.timedelta(days=days)}' THEN {code}"
                     for code, days in zip(RECENCY_CODES, edges))
    return F.expr(f"CASE {whens} WHEN {last_paid} IS NOT NULL THEN {RECENCY_CODES[-1]} END")


def code_label(code: str) -> Column:
    """Label text of the segment code in column ``code`` (NULL stays NULL)."""
    whens = " ".join(f"WHEN {c} THEN {sql_string(label)}" for c, label in sorted(CODE_LABELS.items()))
    return F.expr(f"CASE {code} {whens} END")


def sql_string(text: str) -> str:
    """A Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def flag_names(bucket: int, edges) -> tuple[str, ...]:
    """Honest names of the flags of bucket 0..4 (``purchased_<from>_<to>`` in days)."""
    if bucket == 0:
        return (f"purchased_0_{edges[0]}",)
    if bucket == len(edges):
        return (f"purchased_0_{edges[-1]}", f"purchased_before_{edges[-1]}")
    return (f"purchased_0_{edges[bucket - 1]}", f"purchased_{edges[bucket - 1]}_{edges[bucket]}")


def recency_cohort(orders: DataFrame, p: KpiParams, anchor: dt.date, bucket: int) -> DataFrame:
    """A9-A13 / A16-A19 in their own form: members of one bucket with its flags.

    bucket 0: bought in [anchor-e0, anchor);
    bucket i (1..3): none in [anchor-e(i-1), anchor), some in [anchor-e(i), anchor-e(i-1));
    bucket 4: none in [anchor-e3, anchor), some before anchor-e3.
    """
    edges = p.recency_edges
    paid = F.col("order_paid_time")
    hist = purchase_lines(orders, p)  # max ignores repeated rows
    names = flag_names(bucket, edges)
    if bucket == 0:
        recent = F.max(F.when(in_range(paid, day_offset(anchor, edges[0]), F.lit(anchor)), 1)
                       .otherwise(0))
        return (hist.groupBy("crm_member_id").agg(recent.alias(names[0]))
                .where(F.col(names[0]) == 1))
    newer = F.max(F.when(in_range(paid, day_offset(anchor, edges[bucket - 1]), F.lit(anchor)), 1)
                  .otherwise(0))
    if bucket == len(edges):
        older = F.max(F.when(paid < day_offset(anchor, edges[-1]), 1).otherwise(0))
    else:
        older = F.max(F.when(in_range(paid, day_offset(anchor, edges[bucket]),
                                      day_offset(anchor, edges[bucket - 1])), 1).otherwise(0))
    return (hist.groupBy("crm_member_id").agg(newer.alias(names[0]), older.alias(names[1]))
            .where((F.col(names[0]) == 0) & (F.col(names[1]) == 1)))


def recency_buckets(orders: DataFrame, p: KpiParams) -> DataFrame:
    """AX1: the recency bucket of every member at the start and at the end.

    One aggregate gives each member's latest purchase before either anchor;
    the bucket follows from it.  Returns (crm_member_id, anchor, recency_bucket)
    with anchor 'start' or 'end'.
    """
    paid = F.col("order_paid_time")
    last = (purchase_lines(orders, p)
            .where(paid < F.lit(p.end))
            .groupBy("crm_member_id")
            .agg(F.max(F.when(paid < F.lit(p.start), paid)).alias("last_s"),
                 F.max(paid).alias("last_e")))
    both = last.select(
        "crm_member_id",
        F.inline(F.array(
            F.struct(F.lit("start").alias("anchor"),
                     bucket_code("last_s", p.start, p.recency_edges).alias("code")),
            F.struct(F.lit("end").alias("anchor"),
                     bucket_code("last_e", p.end, p.recency_edges).alias("code")))))
    return both.where(F.col("code").isNotNull()).select(
        "crm_member_id", "anchor", code_label("code").alias("recency_bucket"))
