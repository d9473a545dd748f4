"""Order lines of the period tagged with their member segment.

The reference attaches eleven member sets to the lines with eleven left
joins on the same key.  The member profile already carries every flag, so
one join does it.  Lines without a member bypass the join: their NULL key
would otherwise pile up in a single shuffle partition, and their segment is
known without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions import labels as L
from cohortkit.functions.columns import in_range, is_true, member_key, positive_amount, returned_amount
from cohortkit.functions.labels import SEGMENT_CODES as C
from cohortkit.operators.purchases import sales_lines
from cohortkit.operators.recency import code_label
from cohortkit.params import KpiParams
from cohortkit.plans.member_profile import KEY

LINE_COLS = ("crm_member_id", "if_eff_order_tag", "distributor_name", "eff_reg_channel",
             "original_order_id", "sales_qty", "order_rrp_amt")


def period_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Sales lines of the period without the excluded distributor (members or not)."""
    return sales_lines(orders, p).where(
        (F.col("distributor_name") != p.excluded_distributor)
        & in_range(F.col("date_id"), p.start, p.end))


def segment_flags(profile: DataFrame) -> DataFrame:
    """Integer keys whose lines do not fall to the default segments, one row each."""
    return profile.where(F.col("first_of_key")
                         & ((F.col("seg_v1") != C[L.YTD_SHOPPER]) | F.col("seg_v2").isNotNull())).select(
        KEY, "seg_v1", "seg_v2",
        F.col("key_retain").alias("retained"),
        F.col("key_reactivate").alias("reactivated"),
        F.col("key_other").alias("other_channel"))


def coded_lines(orders: DataFrame, profile: DataFrame, p: KpiParams) -> tuple[DataFrame, DataFrame]:
    """Period lines with segment codes ``seg_v1`` / ``seg_v2`` and the three flags,
    as (member lines, non-member lines)."""
    lines = period_lines(orders, p).select(*LINE_COLS)
    members = lines.where(F.col("crm_member_id").isNotNull()).withColumn(
        KEY, member_key(F.col("crm_member_id")))
    tagged = members.join(segment_flags(profile), on=KEY, how="left").select(
        *LINE_COLS,
        F.coalesce(F.col("seg_v1"), F.lit(C[L.YTD_SHOPPER])).alias("seg_v1"),
        F.col("seg_v2"),
        is_true(F.col("retained")).alias("retained"),
        is_true(F.col("reactivated")).alias("reactivated"),
        is_true(F.col("other_channel")).alias("other_channel"),
        F.col(KEY))
    others = lines.where(F.col("crm_member_id").isNull()).select(
        *LINE_COLS,
        F.lit(C[L.NON_MEMBER]).alias("seg_v1"),
        F.lit(C[L.NON_MEMBER_V2]).alias("seg_v2"),
        F.lit(False).alias("retained"),
        F.lit(False).alias("reactivated"),
        F.lit(False).alias("other_channel"),
        F.lit(None).cast("bigint").alias(KEY))
    return tagged, others


def segmented_lines(orders: DataFrame, profile: DataFrame, p: KpiParams) -> DataFrame:
    """Every period line with member flag, cohort flags and both segment labels."""
    tagged, others = coded_lines(orders, profile, p)
    both = tagged.unionByName(others)
    flag01 = lambda c: F.when(F.col(c), 1).otherwise(0)
    return both.select(
        "crm_member_id", "if_eff_order_tag", "distributor_name", "eff_reg_channel",
        F.when(F.col("crm_member_id").isNull(), "non_member").otherwise("member").alias("is_member_sales"),
        "original_order_id",
        flag01("retained").alias("retained"),
        flag01("reactivated").alias("reactivated"),
        flag01("other_channel").alias("other_channel_reg_new_belong"),
        code_label("seg_v1").alias("member_segment"),
        code_label("seg_v2").alias("member_segment_v2"),
        "sales_qty", "order_rrp_amt")


def order_grain(orders: DataFrame, profile: DataFrame, p: KpiParams) -> DataFrame:
    """Period lines reduced to one row per (member, order), tagged with both codes,
    plus one row for all lines without a member.

    One read of the period and one aggregate: member lines group by (member,
    order), which spreads a member with many orders over all tasks; lines
    without a member fall into a single (NULL, NULL) group, which partial
    aggregation reduces to one row per task.  That row passes the join without
    a match (it is one row, so its NULL key skews nothing) and takes the
    non-member segments.  The join output feeds an aggregate with its own
    shuffle, so AQE is free to split a skewed member partition of the join.
    """
    amt, qty = F.col("order_rrp_amt"), F.col("sales_qty")
    member = F.col("crm_member_id").isNotNull()
    grain = period_lines(orders, p).groupBy(
        "crm_member_id",
        F.when(member, F.col("original_order_id")).alias("original_order_id"),
    ).agg(F.sum(positive_amount(amt, qty)).alias("pos"),
          F.sum(returned_amount(amt, qty)).alias("neg"),
          F.max(is_true(F.col("if_eff_order_tag"))).alias("eff")) \
        .withColumn(KEY, member_key(F.col("crm_member_id")))
    flags = segment_flags(profile).select(KEY, F.col("seg_v1").alias("f1"), F.col("seg_v2").alias("f2"))
    non_member = F.col("crm_member_id").isNull()
    return grain.join(flags, on=KEY, how="left").select(
        "crm_member_id", "original_order_id",
        F.when(non_member, F.lit(C[L.NON_MEMBER]))
         .otherwise(F.coalesce(F.col("f1"), F.lit(C[L.YTD_SHOPPER]))).alias("seg_v1"),
        F.when(non_member, F.lit(C[L.NON_MEMBER_V2])).otherwise(F.col("f2")).alias("seg_v2"),
        "pos", "neg", "eff")
