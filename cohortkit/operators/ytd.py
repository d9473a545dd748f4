"""Year-to-date shoppers and repeat shoppers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import in_range, is_true, positive_amount, returned_amount
from cohortkit.operators.purchases import sales_lines
from cohortkit.params import KpiParams


def ytd_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Member sales lines in [ytd_start, end) without the excluded distributor
    (effective or not: net sales count every line, orders only effective ones)."""
    return sales_lines(orders, p).where(
        (F.col("distributor_name") != p.excluded_distributor)
        & in_range(F.col("date_id"), p.ytd_start, p.end)
        & F.col("crm_member_id").isNotNull())


def ytd_orders(lines: DataFrame, key: str) -> DataFrame:
    """One row per (member, order): is the order effective, and its sales parts.
    Lines without an order id share one row per member; it is no order.

    Grouping on the pair first spreads a member with many orders over all
    tasks; the member-level step that follows combines map-side.
    """
    amt, qty = F.col("order_rrp_amt"), F.col("sales_qty")
    return lines.groupBy(key, "original_order_id").agg(
        F.max(is_true(F.col("if_eff_order_tag"))).alias("eff_order"),
        F.sum(positive_amount(amt, qty)).alias("pos"),
        F.sum(returned_amount(amt, qty)).alias("neg"))


def ytd_repeat(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Year-to-date shoppers with their repeat flag, repeat orders and sales.

    A shopper has an effective line in the window; a repeat shopper has at
    least two distinct effective orders.  Orders and sales are 0 for the
    others.  Net sales include the window's non-effective lines.
    """
    per_member = ytd_orders(ytd_lines(orders, p), "crm_member_id").groupBy("crm_member_id").agg(
        F.max("eff_order").alias("shopper"),
        F.count(F.when(F.col("eff_order"), F.col("original_order_id"))).alias("orders"),
        (F.sum("pos") - F.sum("neg")).alias("sales"))
    repeat = F.col("orders") >= 2
    return per_member.where(F.col("shopper")).select(
        "crm_member_id",
        F.when(repeat, 1).otherwise(0).alias("ytd_repeat"),
        F.when(repeat, F.col("orders")).otherwise(F.lit(0)).cast("bigint").alias("ytd_repeat_orders"),
        F.when(repeat, F.col("sales")).otherwise(F.lit(0)).cast("double").alias("ytd_repeat_member_sales"))
