"""Input tables.

``tpch`` builds the three logical tables from the driver's test parquet;
``read_tables`` reads them from parquet that already has the logical schema
(e.g. a fact table partitioned by ``date_id``, where the period filters of
the operators become partition pruning).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortkit.sources import tpch
from cohortkit.sources.schemas import MEMBER_ORDERS, MEMBERS, SCHEMAS, STORE_TRAFFIC_DAILY, conform


@dataclass(frozen=True)
class Tables:
    member_orders: DataFrame
    members: DataFrame
    store_traffic_daily: DataFrame


def tpch_tables(spark: SparkSession, sf_dir: str, agg_type: str = "STORE") -> Tables:
    t = tpch.tables(spark, sf_dir, agg_type)
    return Tables(t["member_orders"], t["members"], t["store_traffic_daily"])


def read_tables(spark: SparkSession, member_orders: str, members: str,
                store_traffic_daily: str) -> Tables:
    """Read parquet tables holding the logical schemas, checked and cast once here."""
    return Tables(
        conform(spark.read.parquet(member_orders), MEMBER_ORDERS, name="member_orders"),
        conform(spark.read.parquet(members), MEMBERS, name="members"),
        conform(spark.read.parquet(store_traffic_daily), STORE_TRAFFIC_DAILY,
                name="store_traffic_daily"),
    )


__all__ = ["Tables", "tpch_tables", "read_tables", "conform", "SCHEMAS", "MEMBER_ORDERS",
           "MEMBERS", "STORE_TRAFFIC_DAILY", "tpch"]
