"""Hand-made edge rows (FIXTURES.md section 3) for Spark and DuckDB alike."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from cohortkit.params import KpiParams

D, T = dt.date, dt.datetime

# One week, 2024-01-08 .. 2024-01-15; the retain and YTD windows are the years before.
PARAMS = KpiParams(distributor="BUILDING", start=D(2024, 1, 8), end=D(2024, 1, 15),
                   retain_start=D(2023, 1, 1), ytd_start=D(2024, 1, 1),
                   excluded_distributor="LBR", traffic_agg_type="STORE")
S = T(2024, 1, 8)
SEC = dt.timedelta(seconds=1)


def _day(ts: T | None, date_id: D | None = None) -> D:
    return date_id or ts.date()


def line(member, order, paid, qty=1.0, amt="10.00", *, channel="BUILDING", dist="BUILDING",
         rrp=1, eff=True, date_id=None):
    return (member, channel, order, paid, rrp, eff, dist, _day(paid, date_id), qty,
            None if amt is None else Decimal(amt))


def _ago(days: int, extra: dt.timedelta = dt.timedelta(0)) -> T:
    return S - dt.timedelta(days=days) - extra


ORDERS = [
    # 1: new member of the period, a sale and a return with negative amount
    line("1", 101, T(2024, 1, 9, 10), 2.0, "100.00"),
    line("1", 101, T(2024, 1, 9, 10), -1.0, "-30.00"),
    # 2: joined before the period (two channels in the dimension), first buys now
    line("2", 201, T(2024, 1, 10, 12), 1.0, "50.00"),
    # 3: retained (bought in the retain year), one YTD order
    line("3", 301, T(2023, 6, 1, 9), 1.0, "40.00"),
    line("3", 302, T(2024, 1, 12, 18), 3.0, "90.00"),
    # 4: reactivated (bought before the retain year only)
    line("4", 401, T(2022, 3, 1, 8), 1.0, "25.00"),
    line("4", 402, T(2024, 1, 11, 8), 1.0, "25.00"),
    # 5: first purchase in the period through another channel (mixed case)
    line("5", 501, T(2024, 1, 9, 15), 1.0, "60.00", channel="machinery"),
    # 6: first purchase in [ytd_start, start), a second YTD order: repeat shopper
    line("6", 601, T(2024, 1, 3, 11), 1.0, "70.00"),
    line("6", 602, T(2024, 1, 13, 11), 2.0, "80.00"),
    line("6", 602, T(2024, 1, 13, 11), 0.0, "5.00"),          # quantity 0 adds nothing
    line("6", 602, T(2024, 1, 13, 11), -1.0, "20.00"),        # return with positive amount
    # 10-16: recency bucket edges at the start date, to the second
    line("10", 1001, _ago(90)), line("10", 1002, T(2024, 1, 9)),
    line("11", 1101, _ago(90, SEC)), line("11", 1102, T(2024, 1, 9)),
    line("12", 1201, _ago(180)), line("12", 1202, T(2024, 1, 10)),
    line("13", 1301, _ago(180, SEC)), line("13", 1302, T(2024, 1, 10)),
    line("14", 1401, _ago(270)), line("14", 1402, T(2024, 1, 10)),
    line("15", 1501, _ago(360)), line("15", 1502, T(2024, 1, 11)),
    line("16", 1601, _ago(360, SEC)), line("16", 1602, T(2024, 1, 11)),
    # 17: paid exactly at the start (no bucket at the start), and later
    line("17", 1701, S), line("17", 1702, T(2024, 1, 14, 23, 59, 59)),
    # 18: only a purchase without paid time (sorts last, no bucket), buys in period
    line("18", 1801, None, date_id=D(2023, 2, 1)),
    line("18", 1802, T(2024, 1, 9, 9)),
    # 19: two orders paid at the same instant, different channels (tie-break)
    line("19", 1901, T(2024, 1, 9, 9), channel="MACHINERY"),
    line("19", 1902, T(2024, 1, 9, 9), channel="BUILDING"),
    # 20: NULL channel on the first purchase (NOT LIKE drops it)
    line("20", 2001, T(2024, 1, 10, 9), channel=None),
    # 21: joined earlier, bought only at the excluded distributor: never purchased
    #     for the cohorts, but a purchase for the history and recency
    line("21", 2101, T(2023, 12, 1), dist="LBR"),
    line("21", 2102, T(2024, 1, 10)),
    # 22: line with NULL effective flag and one not effective in the period
    line("22", 2201, T(2024, 1, 11), 1.0, "33.00", eff=None),
    line("22", 2202, T(2024, 1, 11), 1.0, "44.00", eff=False),
    # 23: date_id before the period, paid inside it (the CTEs test different dates)
    line("23", 2301, T(2024, 1, 8, 0, 30), date_id=D(2024, 1, 7)),
    line("23", 2302, T(2023, 8, 8)),
    # 24: a line of another sales type and one with NULL distributor
    line("24", 2401, T(2024, 1, 12), rrp=0),
    line("24", 2402, T(2024, 1, 12), dist=None),
    line("24", 2403, T(2023, 9, 1)),
    # 25: two effective YTD orders, both returns: repeat with negative sales
    line("25", 2501, T(2024, 1, 2), -1.0, "-15.00"),
    line("25", 2502, T(2024, 1, 9), -2.0, "-35.00"),
    # non-member lines in the period, and one at another distributor
    line(None, 9001, T(2024, 1, 9, 14), 1.0, "12.50"),
    line(None, 9002, T(2024, 1, 10, 14), -1.0, "-12.50"),
    line(None, 9003, T(2024, 1, 10, 14), 1.0, "99.00", dist="MACHINERY"),
    # 26: amount NULL on a sale line
    line("26", 2601, T(2024, 1, 12), 1.0, None),
    line("26", 2602, T(2023, 3, 3)),
]

MEMBERS = [
    ("1", "BUILDING", T(2024, 1, 9, 7)),
    ("2", "BUILDING", T(2023, 5, 1)),
    ("2", "FURNITURE", T(2023, 5, 1)),
    ("3", "BUILDING", T(2022, 1, 1)),
    ("4", "BUILDING", T(2021, 1, 1)),
    ("5", "MACHINERY", T(2023, 12, 24)),
    ("8", "building", T(2023, 2, 2)),       # upper-cased channel matches; never bought
    ("9", "BUILDING", T(2024, 1, 14, 23)),  # new member without purchases
    ("21", "BUILDING", T(2023, 1, 1)),
    ("27", None, T(2023, 1, 1)),             # NULL channel
    ("28", "BUILDING", None),                # NULL join time
]

TRAFFIC = [
    ("STORE", D(2024, 1, 9), "BUILDING", 100.0),
    ("STORE", D(2024, 1, 10), "BUILDING", 50.0),
    ("STORE", D(2024, 1, 14), "BUILDING", 25.0),
    ("OTHER", D(2024, 1, 10), "BUILDING", 999.0),
    ("STORE", D(2024, 1, 15), "BUILDING", 10.0),
    ("STORE", D(2024, 1, 9), "MACHINERY", 7.0),
]

DUCK_DDL = {
    "member_orders": "crm_member_id VARCHAR, eff_reg_channel VARCHAR, original_order_id BIGINT, "
                     "order_paid_time TIMESTAMP, is_rrp_sales_type INTEGER, if_eff_order_tag BOOLEAN, "
                     "distributor_name VARCHAR, date_id DATE, sales_qty DOUBLE, "
                     "order_rrp_amt DECIMAL(18,2)",
    "members": "member_detail_id VARCHAR, eff_reg_channel VARCHAR, join_time TIMESTAMP",
    "store_traffic_daily": "agg_type VARCHAR, date_id DATE, distributor VARCHAR, "
                           "traffic_amt DOUBLE",
}


def spark_tables(spark, orders=None, members=None, traffic=None):
    from cohortkit.sources import Tables
    from cohortkit.sources.schemas import MEMBERS as MEMBERS_SCHEMA, STORE_TRAFFIC_DAILY, member_orders_schema

    return Tables(
        spark.createDataFrame(ORDERS if orders is None else orders, member_orders_schema()),
        spark.createDataFrame(MEMBERS if members is None else members, MEMBERS_SCHEMA),
        spark.createDataFrame(TRAFFIC if traffic is None else traffic, STORE_TRAFFIC_DAILY),
    )


def duck_tables(orders=None, members=None, traffic=None):
    import duckdb

    con = duckdb.connect()
    data = {"member_orders": ORDERS if orders is None else orders,
            "members": MEMBERS if members is None else members,
            "store_traffic_daily": TRAFFIC if traffic is None else traffic}
    for name, ddl in DUCK_DDL.items():
        con.execute(f"CREATE TABLE {name} ({ddl})")
        rows = data[name]
        if rows:
            marks = ", ".join("?" for _ in rows[0])
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", rows)
    return con
