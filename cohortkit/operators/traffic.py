"""Store traffic of the period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.functions.columns import in_range
from cohortkit.functions.labels import NEW_MEMBER
from cohortkit.params import KpiParams


def traffic_total(store_traffic: DataFrame, p: KpiParams) -> DataFrame:
    """Total traffic of matching stores in the period, always one row,
    labelled as the new-member row (the only row whose rate it feeds)."""
    rows = store_traffic.where(
        (F.col("agg_type") == p.traffic_agg_type)
        & in_range(F.col("date_id"), p.start, p.end)
        & F.col("distributor").like(p.distributor))
    total = rows.agg(F.sum("traffic_amt").cast("double").alias("traffic"))
    # the labelled row comes out of a generator, so the label stays a join key
    # (a literal column would be folded into the join condition, leaving a
    # nested-loop join)
    return total.select(F.inline(F.array(F.struct(F.lit(NEW_MEMBER).alias("member_type"),
                                                  F.col("traffic").alias("traffic")))))
