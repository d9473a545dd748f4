import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortkit.functions.columns import net_sales, ntz_micros, registration_rate, safe_ratio
from cohortkit.params import KpiParams
from cohortkit.plans.member_profile import derive_flags

STAMPS = [dt.datetime(1960, 1, 1, 0, 0, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
          dt.datetime(1970, 1, 1), dt.datetime(2021, 3, 14, 2, 30), dt.datetime(2024, 1, 8, 12, 0, 0, 5)]
EPOCH = dt.datetime(1970, 1, 1)


def _micros(ts):
    d = ts - EPOCH
    return (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds


def test_ntz_micros_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(t,) for t in STAMPS], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r[0] for r in df.select(ntz_micros(F.col("t"))).collect()]
            assert got == [_micros(t) for t in STAMPS], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_first_purchase_day_decodes_from_code(spark):
    # the profile keeps only 2 * micros + other bit; the day comes back exactly,
    # before 1970 too
    rows = [(i, str(i), 2 * _micros(t) + (i % 2)) for i, t in enumerate(STAMPS)]
    df = spark.createDataFrame(rows, "member_key long, member_id string, first_code long").coalesce(1).select(
        "*", F.lit(None).cast("timestamp_ntz").alias("last_paid_s"),
        F.lit(None).cast("timestamp_ntz").alias("last_paid_e"), F.lit(0).alias("flags"),
        F.lit(None).cast("bigint").alias("ytd_orders"), F.lit(None).cast("decimal(28,2)").alias("ytd_sales"))
    p = KpiParams(start=dt.date(2024, 1, 8), end=dt.date(2024, 1, 9), retain_start=dt.date(1950, 1, 1),
                  ytd_start=dt.date(1950, 1, 2))
    flags = derive_flags(df, p).orderBy("member_key").collect()
    # only the 2024-01-08 stamp (index 4, even: matching channel) falls in [start, end)
    assert [r["is_other_channel"] for r in flags] == [False] * 5
    p2 = p.replace(start=dt.date(1969, 12, 31), end=dt.date(1970, 1, 1))
    other = [r["is_other_channel"] for r in derive_flags(df, p2).orderBy("member_key").collect()]
    assert other == [False, True, False, False, False]


def test_ratios_and_net_sales(spark):
    df = spark.createDataFrame(
        [(2.0, Decimal("10.00")), (-1.0, Decimal("-3.00")), (-1.0, Decimal("4.00")), (0.0, Decimal("7.00")),
         (1.0, None)], "qty double, amt decimal(18,2)")
    assert df.agg(net_sales(F.col("amt"), F.col("qty"))).first()[0] == Decimal("3.00")
    assert df.where("qty > 5").agg(net_sales(F.col("amt"), F.col("qty"))).first()[0] is None
    r = spark.range(1).select(
        safe_ratio(F.lit(3), F.lit(0)).alias("a"), safe_ratio(F.lit(3), F.lit(None).cast("long")).alias("b"),
        safe_ratio(F.lit(3), F.lit(4)).alias("c"),
        registration_rate(F.lit(2), F.lit(175.0)).alias("d"),
        registration_rate(F.lit(2), F.lit(0.0)).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == (0.0, 0.0, 0.75, 0.0114, None)


def test_hour_slices_follow_the_paid_order(spark):
    # the rank numbers purchases per (member, hour slice): the slice must never
    # decrease along paid time, NULL paid times last
    import random

    from cohortkit.operators.purchases import purchase_hour

    rnd = random.Random(5)
    base = dt.datetime(1901, 1, 1)
    stamps = [base + dt.timedelta(microseconds=rnd.randrange(0, 298 * 365 * 86_400_000_000))
              for _ in range(2000)] + [None]
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    rows = df.select("t", ntz_micros(F.col("t")).alias("us"), purchase_hour(F.col("t")).alias("h")).collect()
    for r in rows:
        if r.t is not None:
            assert r.us == _micros(r.t)
            assert r.h == _micros(r.t) // 3_600_000_000
    ordered = sorted(rows, key=lambda r: (r.t is None, r.t or base))
    hours = [r.h for r in ordered]
    assert hours == sorted(hours)
