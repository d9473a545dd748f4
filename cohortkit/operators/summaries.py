"""Segment summaries and cohort sizes.

Everything after the segment aggregate has at most one row per report label,
a fixed set of 15, so joins between these frames broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import labels as L
from cohortkit.operators.recency import code_label, sql_string

SUMMARY_COLS = ("ttl_sales", "member_sales", "member_shopper", "member_orders")


def segment_summaries(order_grain: DataFrame) -> DataFrame:
    """A23 and A24 in one aggregate: sales, shoppers and orders per segment.

    ``order_grain`` holds one row per (member, order) with both segment
    codes; each row is counted once under ``version`` 1 (``seg_v1``) and once
    under ``version`` 2 (``seg_v2``), so the order grain is read once.  Sales
    stay decimal; ``member_type`` is the label (NULL for lines without a v2
    segment).
    """
    both = order_grain.select(
        "*", F.inline(F.array(F.struct(F.lit(1).alias("version"), F.col("seg_v1").alias("code")),
                              F.struct(F.lit(2).alias("version"), F.col("seg_v2").alias("code")))))
    member = F.col("crm_member_id").isNotNull()
    eff = F.col("eff")
    agg = both.groupBy("version", "code").agg(
        (F.sum("pos") - F.sum("neg")).alias("ttl_sales"),
        (F.sum(F.when(member, F.col("pos")).otherwise(F.lit(0)))
         - F.sum(F.when(member, F.col("neg")).otherwise(F.lit(0)))).alias("member_sales"),
        F.count_distinct(F.when(eff, F.col("crm_member_id"))).alias("member_shopper"),
        F.count_distinct(F.when(eff & member, F.col("original_order_id"))).alias("member_orders"))
    return agg.select("version", code_label("code").alias("member_type"), *SUMMARY_COLS)


def segment_summary(both: DataFrame, version: int) -> DataFrame:
    """A23 (version 1) or A24 (version 2) out of :func:`segment_summaries`."""
    return both.where(F.col("version") == version).select("member_type", *SUMMARY_COLS)


def summary_output(summary: DataFrame) -> DataFrame:
    """A summary with sales as double, as reported."""
    return summary.select("member_type", F.col("ttl_sales").cast("double").alias("ttl_sales"),
                          F.col("member_sales").cast("double").alias("member_sales"),
                          "member_shopper", "member_orders")


def cohort_counts(profile: DataFrame) -> DataFrame:
    """One row: size of every cohort, recency bucket, lapsed set and the YTD figures.

    The aggregates are written as SQL expressions: one parse for the whole
    list instead of a round trip per column function.
    """
    n = lambda cond, name: f"count(CASE WHEN {cond} THEN 1 END) AS {name}"
    exprs = [
        n("is_new", "new"), n("is_never", "never"), n("is_retain", "retain"),
        n("is_reactivate", "reactivate"), n("is_ytd_first", "ytd_first"),
        n("is_other_channel", "other_channel"),
        *[n(f"recency_start = {c}", f"start_{c}") for c in L.RECENCY_CODES],
        *[n(f"recency_end = {c}", f"end_{c}") for c in L.RECENCY_CODES],
        n("not_retained", "not_retained"), n("not_reactivated", "not_reactivated"),
        n("ytd_shopper", "ytd_shoppers"), n("ytd_repeat", "ytd_repeaters"),
        n("ytd_shopper AND NOT ytd_repeat", "ytd_single"),
        "sum(CASE WHEN ytd_shopper THEN CASE WHEN ytd_repeat THEN ytd_sales ELSE 0 END END) AS ytd_sales",
        "sum(CASE WHEN ytd_shopper THEN CASE WHEN ytd_repeat THEN ytd_orders ELSE 0 END END) AS ytd_orders",
    ]
    return profile.agg(*[F.expr(e) for e in exprs])


BASE, RECENCY_BASE, RECALL, YTD = "base", "recency_base", "recall", "ytd"


def labelled_counts(counts: DataFrame) -> DataFrame:
    """All labelled count rows of the report in one frame: (section, member_type, n).

    ``base``: A25 cohort sizes (the non-member row, base 0, only if there are
    new members); ``recency_base``: A27 bucket sizes at the start;
    ``recall``: A32 members still to win back at the end; ``ytd``: the YTD
    repeat row of A26 (shoppers in ``n``, plus repeat sales, repeaters and
    their orders).  One generator over the one-row counts, so every consumer
    reads the same plan.
    """
    rows = [
        (BASE, L.NON_MEMBER, "CASE WHEN new > 0 THEN 0 END"),
        (BASE, L.NEW_MEMBER, "new"),
        (BASE, L.NEVER_PURCHASED, "never"),
        (BASE, L.RETAINED, "retain"),
        (BASE, L.REACTIVATED, "reactivate"),
        (BASE, L.YTD_SHOPPER, "ytd_first"),
        (BASE, L.OTHER_CHANNEL, "other_channel"),
        *[(RECENCY_BASE, label, f"start_{code}")
          for label, code in zip(L.RECENCY_LABELS, L.RECENCY_CODES)],
        (RECALL, L.RETAINED, "not_retained"),
        (RECALL, L.REACTIVATED, "not_reactivated"),
        *[(RECALL, label, f"end_{code}")
          for label, code in zip(L.RECENCY_LABELS[1:], L.RECENCY_CODES[1:])],
        (RECALL, L.YTD_REPEAT, "ytd_single"),
    ]
    structs = [f"named_struct('section', {sql_string(section)}, 'member_type', {sql_string(label)}, "
               f"'n', CAST({value} AS BIGINT), 'sales', CAST(NULL AS DECIMAL(38,2)), "
               f"'shoppers', CAST(NULL AS BIGINT), 'orders', CAST(NULL AS BIGINT))"
               for section, label, value in rows]
    structs.append(f"named_struct('section', {sql_string(YTD)}, 'member_type', {sql_string(L.YTD_REPEAT)}, "
                   f"'n', CAST(ytd_shoppers AS BIGINT), 'sales', CAST(ytd_sales AS DECIMAL(38,2)), "
                   f"'shoppers', CAST(ytd_repeaters AS BIGINT), 'orders', CAST(ytd_orders AS BIGINT))")
    return counts.selectExpr(f"inline(array({', '.join(structs)}))").where(F.col("n").isNotNull())


def _section(labelled: DataFrame, section: str, value: str) -> DataFrame:
    return labelled.where(F.col("section") == section).select(
        "member_type", F.col("n").alias(value))


def member_base_summary(labelled: DataFrame) -> DataFrame:
    """Cohort sizes."""
    return _section(labelled, BASE, "member_base")


def recency_base_summary(labelled: DataFrame) -> DataFrame:
    """Sizes of the five recency buckets at the start date."""
    return _section(labelled, RECENCY_BASE, "member_base")


def recall_counts(labelled: DataFrame) -> DataFrame:
    """Members still to win back at the end of the period."""
    return _section(labelled, RECALL, "still_need_to_recall")


def rollups(labelled: DataFrame, summaries: DataFrame) -> DataFrame:
    """A26 (``version`` 1) and A28 (``version`` 2) as one frame.

    Cohort and bucket sizes are joined to their segment's sales by (version,
    label).  Version 1 adds the existing subtotal, the total and the YTD row.
    Subtotal and total add distinct counts of cohorts that may overlap, as
    the report defines them; they are not a ROLLUP of the members.  They come
    from GROUPING SETS over the joined rows: (version, label) returns each row
    as it is, the two derived keys give the subtotal and the total, so the
    joined rows (and the segment summaries under them) are read once.
    """
    base = labelled.where(F.col("section").isin(BASE, RECENCY_BASE)).select(
        F.when(F.col("section") == BASE, 1).otherwise(2).alias("version"),
        "member_type", F.col("n").alias("member_base"))
    v1 = F.col("version") == 1
    rows = base.join(F.broadcast(summaries), on=["version", "member_type"], how="left").select(
        "version", "member_type", "member_base", *SUMMARY_COLS,
        F.when(v1 & F.col("member_type").like("%existing%"), F.lit(L.EXISTING)).alias("g_existing"),
        F.when(v1, F.lit(L.TTL)).alias("g_total"))
    cols = ("member_base", *SUMMARY_COLS)
    sets = rows.groupingSets([["version", "member_type"], ["g_existing"], ["g_total"]],
                             "version", "member_type", "g_existing", "g_total").agg(
        *[F.sum(c).alias(c) for c in cols])
    identity = F.col("version").isNotNull()
    out = sets.where(identity | F.col("g_existing").isNotNull() | F.col("g_total").isNotNull()).select(
        F.when(identity, F.col("version")).otherwise(F.lit(1)).alias("version"),
        F.coalesce(F.col("member_type"), F.col("g_existing"), F.col("g_total")).alias("member_type"),
        *[F.col(c) for c in cols])
    ytd = labelled.where(F.col("section") == YTD).select(
        F.lit(1).alias("version"), "member_type",
        F.col("n").alias("member_base"),
        F.col("sales").alias("ttl_sales"),
        F.col("sales").alias("member_sales"),
        F.col("shoppers").alias("member_shopper"),
        F.col("orders").alias("member_orders"))
    # both carry (version, member_type, member_base, *SUMMARY_COLS) in this order
    return out.union(ytd)


def rollup(both: DataFrame, version: int) -> DataFrame:
    """A26 (version 1) or A28 (version 2) out of :func:`rollups`."""
    return both.where(F.col("version") == version).select("member_type", "member_base", *SUMMARY_COLS)


def rollup_output(rollup: DataFrame) -> DataFrame:
    return rollup.select("member_type", "member_base",
                         F.col("ttl_sales").cast("double").alias("ttl_sales"),
                         F.col("member_sales").cast("double").alias("member_sales"),
                         "member_shopper", "member_orders")


__all__ = ["segment_summaries", "segment_summary", "summary_output", "cohort_counts",
           "labelled_counts", "member_base_summary", "recency_base_summary", "recall_counts",
           "rollups", "rollup", "rollup_output"]
