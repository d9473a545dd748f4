"""Randomised differential test: seeded random tables, Spark against the oracle."""

import datetime as dt
import random
from decimal import Decimal

import pytest

import fixtures as fx
from cohortkit.plans import oracle
from cohortkit.plans.registry import registry
from oracle_compare import same_rows

P = fx.PARAMS
CHANNELS = ["BUILDING", "building", "MACHINERY", "FURNITURE", None]
DISTRIBUTORS = ["BUILDING", "BUILDING", "MACHINERY", "LBR", None]
KEYS = ("weekly_kpi", "segmented_lines", "recency_buckets", "purchase_rank", "first_purchase",
        "ytd_repeat", "never_purchased_base", "reactivate_base", "other_channel_base",
        "not_retained", "not_reactivated", "kpi_rollup", "recency_rollup", "count_distinct_filtered",
        "join_two_key", "repeat_having")


def _paid(rnd):
    # dates clustered around the windows: history, retain year, YTD, period, after
    anchors = [P.retain_start - dt.timedelta(days=400), P.retain_start, P.ytd_start,
               P.start - dt.timedelta(days=100), P.start, P.end]
    base = rnd.choice(anchors)
    day = dt.datetime.combine(base, dt.time()) + dt.timedelta(days=rnd.randint(-40, 40))
    return day + dt.timedelta(seconds=rnd.choice([0, 0, 1, 3600, 86399]))


def make(seed: int, n_members=40, n_orders=220):
    rnd = random.Random(seed)
    orders = []
    for o in range(n_orders):
        member = None if rnd.random() < 0.15 else str(rnd.randint(1, n_members))
        paid = None if rnd.random() < 0.03 else _paid(rnd)
        date_id = (paid.date() if paid else P.start) + dt.timedelta(days=rnd.choice([0, 0, 0, -1, 1]))
        channel = rnd.choice(CHANNELS)
        dist = rnd.choice(DISTRIBUTORS)
        eff = rnd.choice([True, True, True, False, None])
        for _ in range(rnd.randint(1, 3)):
            qty = rnd.choice([1.0, 2.0, -1.0, 0.0])
            amt = Decimal(rnd.randint(-500, 5000)) / 100 if rnd.random() > 0.03 else None
            orders.append((member, channel, 1000 + o, paid, rnd.choice([1, 1, 1, 0]), eff, dist,
                           date_id, qty, amt))
    members = []
    for m in range(1, n_members + 1):
        for _ in range(rnd.choice([1, 1, 2])):
            join = _paid(rnd) if rnd.random() > 0.05 else None
            members.append((str(m), rnd.choice(CHANNELS), join))
    traffic = [(rnd.choice(["STORE", "STORE", "OTHER"]),
                P.start + dt.timedelta(days=rnd.randint(-3, 9)),
                rnd.choice(["BUILDING", "MACHINERY"]), float(rnd.randint(0, 50)))
               for _ in range(30)]
    return orders, members, traffic


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("pattern", ["BUILDING", "%"])
def test_random_tables_match_oracle(spark, seed, pattern):
    orders, members, traffic = make(seed)
    tables = fx.spark_tables(spark, orders, members, traffic)
    duck = fx.duck_tables(orders, members, traffic)
    params = P.replace(distributor=pattern)
    for key in KEYS:
        q = registry()[key]
        df = q.on_tables(tables, params)
        rel = duck.sql(oracle.query(params, q.oracle_select, mapping=False))
        status = same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
        assert status == "match", (seed, pattern, key, status)


PARAM_KEYS = ("weekly_kpi", "segmented_lines", "recency_buckets", "ytd_repeat", "not_reactivated",
              "other_channel_base", "ytd_first_purchase_base", "never_purchased_base")


def _random_params(rnd):
    start = P.start + dt.timedelta(days=rnd.randint(-60, 30))
    end = start + dt.timedelta(days=rnd.choice([1, 7, 30, 91]))
    ytd = start - dt.timedelta(days=rnd.choice([-5, 0, 20, 200]))   # may lie after the start
    retain = ytd - dt.timedelta(days=rnd.choice([0, 100, 365]))
    return P.replace(start=start, end=end, ytd_start=ytd, retain_start=retain,
                     distributor=rnd.choice(["BUILDING", "%", "MACH%", "%ING", "_UILDING"]))


@pytest.mark.parametrize("seed", [11, 12, 13, 14, 15, 22])  # 15, 22: ytd_start after start
def test_random_parameters_match_oracle(spark, seed):
    rnd = random.Random(seed)
    orders, members, traffic = make(seed)
    tables = fx.spark_tables(spark, orders, members, traffic)
    duck = fx.duck_tables(orders, members, traffic)
    params = _random_params(rnd)
    for key in PARAM_KEYS:
        q = registry()[key]
        df = q.on_tables(tables, params)
        rel = duck.sql(oracle.query(params, q.oracle_select, mapping=False))
        status = same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
        assert status == "match", (seed, params, key, status)


@pytest.mark.parametrize("seed,n_members,n_orders", [(101, 5, 500), (102, 120, 300)])
def test_dense_and_sparse_histories(spark, seed, n_members, n_orders):
    # few members with long histories (ties, ranks, first purchases) and many
    # members with short ones
    rnd = random.Random(seed)
    orders, members, traffic = make(seed, n_members=n_members, n_orders=n_orders)
    tables = fx.spark_tables(spark, orders, members, traffic)
    duck = fx.duck_tables(orders, members, traffic)
    params = _random_params(rnd)
    for key in KEYS:
        q = registry()[key]
        df = q.on_tables(tables, params)
        rel = duck.sql(oracle.query(params, q.oracle_select, mapping=False))
        status = same_rows(df.columns, [tuple(r) for r in df.collect()], rel.columns, rel.fetchall())
        assert status == "match", (seed, key, status)
