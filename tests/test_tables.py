"""Logical tables read from parquet, the fact partitioned by ``date_id``."""

import tempfile

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from cohortkit.operators.segments import period_lines
from cohortkit.plans.materialize import materialize
from cohortkit.plans.weekly import WeeklyKpi
from cohortkit.sources import read_tables
from oracle_compare import same_rows


@pytest.fixture(scope="module")
def stored(spark):
    t = fx.spark_tables(spark)
    root = tempfile.mkdtemp(prefix="cohortkit-tables-")
    t.member_orders.write.partitionBy("date_id").parquet(f"{root}/member_orders")
    t.members.write.parquet(f"{root}/members")
    t.store_traffic_daily.write.parquet(f"{root}/store_traffic_daily")
    return t, read_tables(spark, f"{root}/member_orders", f"{root}/members", f"{root}/store_traffic_daily")


def _rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def test_report_from_parquet_equals_in_memory(stored):
    mem, disk = stored
    a = _rows(WeeklyKpi(mem, fx.PARAMS).report)
    b = _rows(WeeklyKpi(disk, fx.PARAMS).report)
    assert same_rows(*a, *b) == "match"


def test_schema_is_conformed(stored):
    _, disk = stored
    assert disk.member_orders.schema["date_id"].dataType.simpleString() == "date"
    assert disk.member_orders.columns[0] == "crm_member_id"


def test_period_prunes_date_partitions(stored):
    _, disk = stored
    df = period_lines(disk.member_orders, fx.PARAMS)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in text and "date_id" in text.split("PartitionFilters")[1]


@pytest.mark.parametrize("mode", ["checkpoint", "table", "persist", "none"])
def test_materialize_modes_keep_rows(spark, mode):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("g"))
    out = materialize(df, "probe", mode)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))


def test_tables_with_exactly_the_statements_columns(spark, tmp_path):
    # string order ids, yyyymmdd days of the store table, no store id
    from pyspark.sql import types as T

    t = fx.spark_tables(spark)
    orders = t.member_orders.withColumn("original_order_id", F.concat(F.lit("SO-"), F.col("original_order_id")))
    orders.write.parquet(f"{tmp_path}/o")
    t.members.write.parquet(f"{tmp_path}/m")
    t.store_traffic_daily.withColumn("date_id", F.date_format("date_id", "yyyyMMdd").cast("int")).write.parquet(f"{tmp_path}/s")
    disk = read_tables(spark, f"{tmp_path}/o", f"{tmp_path}/m", f"{tmp_path}/s")
    assert isinstance(disk.member_orders.schema["original_order_id"].dataType, T.StringType)
    assert same_rows(*_rows(WeeklyKpi(t, fx.PARAMS).report), *_rows(WeeklyKpi(disk, fx.PARAMS).report)) == "match"


@pytest.mark.parametrize("column,kind", [("order_rrp_amt", "decimal(18,4)"), ("date_id", "timestamp"), ("sales_qty", "string")])
def test_a_cast_that_could_change_values_is_refused(spark, column, kind):
    from cohortkit.sources import MEMBER_ORDERS, conform

    df = fx.spark_tables(spark).member_orders
    with pytest.raises(ValueError, match=column):
        conform(df.withColumn(column, F.col(column).cast(kind)), MEMBER_ORDERS)


def test_a_bound_with_a_time_of_day_is_refused():
    import datetime as dt

    from cohortkit.params import KpiParams

    assert KpiParams(start=dt.datetime(2000, 10, 1)).start == dt.date(2000, 10, 1)
    with pytest.raises(ValueError):
        KpiParams(start=dt.datetime(2000, 10, 1, 8))
