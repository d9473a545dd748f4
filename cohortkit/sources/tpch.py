"""The logical tables built from the driver's TPC-H-style parquet files.

The mapping is the one of FIXTURES.md section 2.  Each function returns a
lazy DataFrame; filters and projections of the caller are pushed through the
joins into the parquet scans by Catalyst.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.columns import MONEY

# Fixed values of the test mapping (FIXTURES.md section 2).
PRIORITY_TO_DISTRIBUTOR = {
    "1-URGENT": "BUILDING",
    "2-HIGH": "MACHINERY",
    "3-MEDIUM": "FURNITURE",
    "4-NOT SPECIFIED": "HOUSEHOLD",
    "5-LOW": "LBR",
}
SUPPLIER_TO_DISTRIBUTOR = ("BUILDING", "MACHINERY", "FURNITURE", "HOUSEHOLD")  # by l_suppkey % 4
JOIN_EPOCH = dt.date(1995, 1, 1)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _case(col, mapping: dict) -> F.Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, value) if expr is None else expr.when(col == key, value)
    return expr


def member_orders(spark: SparkSession, sf_dir: str, raw: dict | None = None) -> DataFrame:
    """Order-line fact: lineitem x orders x customer."""
    raw = raw or _raw(spark, sf_dir)
    li = raw["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    od = raw["orders"].select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = raw["customer"].select("c_custkey", "c_mktsegment")
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).join(
        cu, F.col("o_custkey") == F.col("c_custkey"))
    returned = F.col("l_returnflag") == "R"
    return j.select(
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("crm_member_id"),
        F.col("c_mktsegment").alias("eff_reg_channel"),
        F.col("o_orderkey").alias("original_order_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_paid_time"),
        F.when(F.col("l_linenumber") == 7, 0).otherwise(1).cast("int").alias("is_rrp_sales_type"),
        (F.col("o_orderstatus") != "P").alias("if_eff_order_tag"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_DISTRIBUTOR).alias("distributor_name"),
        F.to_date(F.col("o_orderdate")).alias("date_id"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("sales_qty"),
        F.when(returned, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
         .cast(MONEY).alias("order_rrp_amt"),
    )


def members(spark: SparkSession, sf_dir: str, raw: dict | None = None) -> DataFrame:
    """Member dimension: one row per customer."""
    cu = (raw or _raw(spark, sf_dir))["customer"].select("c_custkey", "c_mktsegment")
    offset = (F.col("c_custkey") * 37 % 2400).cast("int")
    return cu.select(
        F.col("c_custkey").cast("string").alias("member_detail_id"),
        F.col("c_mktsegment").alias("eff_reg_channel"),
        F.date_add(F.lit(JOIN_EPOCH), offset).cast("timestamp_ntz").alias("join_time"),
    )


def store_traffic_daily(spark: SparkSession, sf_dir: str, agg_type: str = "STORE",
                        raw: dict | None = None) -> DataFrame:
    """Store-day traffic: lineitem quantity per supplier and ship day."""
    li = (raw or _raw(spark, sf_dir))["lineitem"].select("l_suppkey", "l_shipdate", "l_quantity")
    return (
        li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date_id"))
        .agg(F.sum("l_quantity").alias("traffic_amt"))
        .select(
            F.lit(agg_type).alias("agg_type"),
            "date_id",
            _case(F.col("l_suppkey") % 4, dict(enumerate(SUPPLIER_TO_DISTRIBUTOR))).alias("distributor"),
            "traffic_amt",
        )
    )


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver tables the mapping reads, each read (listed) once."""
    return {name: _read(spark, sf_dir, name) for name in ("lineitem", "orders", "customer")}


def tables(spark: SparkSession, sf_dir: str, agg_type: str = "STORE") -> dict[str, DataFrame]:
    raw = _raw(spark, sf_dir)
    return {
        "member_orders": member_orders(spark, sf_dir, raw),
        "members": members(spark, sf_dir, raw),
        "store_traffic_daily": store_traffic_daily(spark, sf_dir, agg_type, raw),
    }
