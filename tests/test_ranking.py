"""The sliced row number equals ``row_number()`` and splits a hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import fixtures as fx
from cohortkit.operators import purchases
from cohortkit.operators.ranking import row_number_within


def _data(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows on one key, some NULL keys, the rest spread
        key = "hot" if i % 3 == 0 else (None if i % 29 == 0 else f"k{rnd.randrange(200)}")
        rows.append((key, None if i % 31 == 0 else rnd.randrange(50), i))
    return rows


def test_matches_window_row_number(spark):
    df = spark.createDataFrame(_data(), "k string, t int, id int")
    order = [F.col("t").asc_nulls_last(), F.col("id").asc()]
    bucket = F.coalesce(F.floor(F.col("t") / 5), F.lit(10**6))
    got = row_number_within(df, ["k"], order, [bucket], "rk")
    want = df.withColumn("rk", F.row_number().over(Window.partitionBy("k").orderBy(*order)))

    assert got.count() == df.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_hot_key_spreads_over_tasks(spark):
    # the numbering shuffle is keyed by (key, bucket): the hot key's rows land
    # in several partitions
    df = spark.createDataFrame(_data(), "k string, t int, id int")
    bucket = F.floor(F.col("t") / 5)
    parts = (df.repartition(8, "k", bucket).where(F.col("k") == "hot")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts >= 2


def test_one_hour_with_thousands_of_purchases(spark):
    # one member, one hour, different seconds: every task gets its part, and the ranks are right
    df = spark.createDataFrame([("m", i % 3600, i) for i in range(7200)], "k string, sec int, id int")
    order = [F.col("sec").asc(), F.col("id").asc()]
    hour = F.floor(F.col("sec") / 3600)
    got = row_number_within(df, ["k"], order, [hour, F.col("sec")], "rk")
    want = df.withColumn("rk", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert got.exceptAll(want).count() == 0 and got.count() == 7200
    sizes = [r.n for r in df.repartition(8, "k", hour, "sec").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("dtype", ["bigint", "string", "decimal(20,2)"])
def test_thousands_of_purchases_at_one_instant(spark, dtype):
    # one member, one second (two instants in it, both channels): the order ids make the slices
    ids = [i * 37 % 40_000 for i in range(0, 40_000, 2)]
    paid = dt.datetime(2024, 1, 9, 10)
    rows = [fx.line("7", n, paid + dt.timedelta(microseconds=n % 2), channel=("BUILDING", "MACHINERY", None)[n % 3]) for n in ids]
    rows += [fx.line("7", None, paid), fx.line("7", None, None, date_id=dt.date(2024, 1, 9)), fx.line("8", 5, paid)]
    orders = fx.spark_tables(spark, rows).member_orders
    orders = orders.withColumn("original_order_id", F.col("original_order_id").cast(dtype))
    got = purchases.purchase_rank(orders, fx.PARAMS)
    want = purchases.purchase_events(orders, fx.PARAMS).withColumn("rk", F.row_number().over(
        Window.partitionBy("crm_member_id").orderBy(*purchases.purchase_order(fx.PARAMS))))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 20_003
    slices = orders.select(purchases.order_range(F.col("original_order_id"), orders.schema["original_order_id"].dataType)).distinct()
    assert slices.count() >= 10
