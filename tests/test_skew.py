"""A member holding a third of all order lines: results stay exact.

The driver's sf0.001 tables are remapped so that every order of every third
customer belongs to member 7; the same rows go to DuckDB, and the flagship
keys are compared with the oracle.
"""

import os

import pytest
from pyspark.sql import functions as F

from cohortkit.params import KpiParams
from cohortkit.plans import oracle
from cohortkit.plans.registry import registry
from cohortkit.sources import Tables, tpch_tables
from oracle_compare import same_rows

SF = "/root/testdata/sf0.001"
KEYS = ("weekly_kpi", "segmented_lines", "purchase_rank", "first_purchase", "recency_buckets",
        "ytd_repeat", "reactivate_base", "not_reactivated")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def skewed(t: Tables) -> Tables:
    cust = F.col("crm_member_id").cast("bigint")
    hot = F.when(cust % 3 == 0, F.lit("7")).otherwise(F.col("crm_member_id"))
    return Tables(t.member_orders.withColumn("crm_member_id", hot), t.members, t.store_traffic_daily)


def test_hot_member_share(spark):
    t = skewed(tpch_tables(spark, SF))
    share = t.member_orders.agg(F.avg((F.col("crm_member_id") == "7").cast("int"))).first()[0]
    assert share > 0.25


@pytest.mark.parametrize("pattern", ["BUILDING", "%"])
def test_hot_member_matches_oracle(spark, pattern):
    import duckdb

    t = skewed(tpch_tables(spark, SF))
    con = duckdb.connect()
    for name, df in (("member_orders", t.member_orders), ("members", t.members),
                     ("store_traffic_daily", t.store_traffic_daily)):
        pdf = df.toPandas()  # fine at sf0.001: a test fixture, not a code path
        con.register(f"{name}_pdf", pdf)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_pdf")
    # keep DuckDB's types equal to Spark's
    con.execute("CREATE OR REPLACE TABLE member_orders AS SELECT crm_member_id, eff_reg_channel, "
                "original_order_id, CAST(order_paid_time AS TIMESTAMP) AS order_paid_time, "
                "is_rrp_sales_type, if_eff_order_tag, distributor_name, CAST(date_id AS DATE) AS date_id, "
                "sales_qty, CAST(order_rrp_amt AS DECIMAL(18,2)) AS order_rrp_amt FROM member_orders")
    con.execute("CREATE OR REPLACE TABLE members AS SELECT member_detail_id, eff_reg_channel, "
                "CAST(join_time AS TIMESTAMP) AS join_time FROM members")
    p = KpiParams(distributor=pattern)
    for key in KEYS:
        q = registry()[key]
        df = q.on_tables(t, p)
        rel = con.sql(oracle.query(p, q.oracle_select, mapping=False))
        status = same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
        assert status == "match", (pattern, key, status)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_aqe_splits_the_hot_member_in_the_period_join(spark):
    # with sort-merge joins forced and small thresholds, AQE cuts the hot
    # member's partition of the period join: both join inputs are shuffles
    # because the profile is checkpointed
    from cohortkit.plans.weekly import WeeklyKpi

    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        grain = WeeklyKpi(skewed(tpch_tables(spark, "/root/testdata/sf0.01")), KpiParams()).order_grain
        grain.collect()
        plan = grain._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
