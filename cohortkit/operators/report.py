"""KPI ratios and the final report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import registration_rate, safe_ratio

FINAL_COLS = ("member_type", "ttl_sales", "traffic", "registration_rate", "member_base", "CR",
              "member_shopper", "member_frequency", "member_atv", "member_sales")
REPORT_COLS = (*FINAL_COLS, "still_need_to_recall")


def kpi_final(rollups: DataFrame, traffic: DataFrame) -> DataFrame:
    """A29 (version 1) and A30 (version 2): ratios of the rollups.

    Traffic attaches to the row with its label only (the new-member row of
    version 1; no version 2 row has that label).
    """
    j = rollups.join(F.broadcast(traffic), on="member_type", how="left")
    return j.select(
        "version", "member_type",
        F.col("ttl_sales").cast("double").alias("ttl_sales"),
        F.col("traffic"),
        registration_rate(F.col("member_base"), F.col("traffic")).alias("registration_rate"),
        F.col("member_base"),
        safe_ratio(F.col("member_shopper"), F.col("member_base")).alias("CR"),
        F.col("member_shopper"),
        safe_ratio(F.col("member_orders"), F.col("member_shopper")).alias("member_frequency"),
        safe_ratio(F.col("member_sales"), F.col("member_orders")).alias("member_atv"),
        F.col("member_sales").cast("double").alias("member_sales"))


def kpi_version(final: DataFrame, version: int) -> DataFrame:
    """A29 (version 1) or A30 (version 2) out of :func:`kpi_final`."""
    return final.where(F.col("version") == version).select(*FINAL_COLS)


def kpi_union(final: DataFrame) -> DataFrame:
    """Segment rows and recency rows."""
    return final.select(*FINAL_COLS)


def weekly_kpi_report(final_union: DataFrame, recall: DataFrame) -> DataFrame:
    """The report with the still-to-recall count on the rows that have one."""
    return final_union.join(F.broadcast(recall), on="member_type", how="left").select(*REPORT_COLS)
