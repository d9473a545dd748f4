"""One row per member id with every cohort flag of a run.

The reference derives each cohort with its own scan of the order fact and
joins all of them back to the period's order lines one by one.  Here the
member-level facts are collected by a single ``groupBy(member_key)`` over a
union of three narrow inputs:

* the effective purchase history (one full scan of the fact),
* year-to-date orders, already reduced to one row per (member, order),
* member dimension rows.

Every aggregate in it (max, min, sum, count) combines map-side, so a member
with a huge history costs one row per task in the shuffle.  The cohorts,
both recency buckets, the lapsed flags and both segment codes are column
expressions over the result.

The statement counts ids as they are written, but attaches member sets to
lines by the integer value of the id, so ``'7'`` and ``'07'`` are two members
of every count and one member of every join.  The profile therefore has one
row per written id, and what holds for the integer key (``any_``, the segment
codes) is taken over the key's rows, nearly always one: two spellings need an
id that differs from its key's digits, and only keys with such an id are
gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import in_range, is_true, member_key, upper_like
from cohortkit.functions import labels as L
from cohortkit.functions.labels import SEGMENT_CODES as C
from cohortkit.operators.purchases import (
    first_code_day,
    first_code_other,
    first_purchase_code,
    sales_lines,
)
from cohortkit.operators.recency import bucket_code
from cohortkit.operators.ytd import ytd_lines, ytd_orders
from cohortkit.params import KpiParams
from cohortkit.plans.materialize import materialize, write_table

# ids not written as their key, up to which their keys (8 bytes each) are broadcast
MAX_BROADCAST_KEYS = 100_000

KEY = "member_key"
ID = "member_id"  # the id as written

# Boolean member facts travel as bits of one int and are combined with
# ``bit_or``: every field of a shuffled row costs 8 bytes, and this is the
# largest shuffle of the report.
BITS = {
    "bought_ytd": 1,          # a purchase (A1) paid in [ytd_start, end)
    "bought_before_s": 2,     # effective, not excluded, date_id < start
    "in_retain": 4,           # effective, not excluded, date_id in [retain_start, ytd_start)
    "bought_before_rs": 8,    # effective, not excluded, date_id < retain_start
    "ytd_shopper": 16,        # an effective YTD order
    "joined_in_period": 32,   # joined in [start, end) through a matching channel
    "joined_before_s": 64,    # joined before start through a matching channel
}


def _bits(**conds) -> F.Column:
    expr = F.lit(0)
    for name, cond in conds.items():
        expr = expr + F.when(cond, F.lit(BITS[name])).otherwise(F.lit(0))
    return expr.cast("int").alias("flags")


def has(name: str, flags: str = "flags") -> F.Column:
    """The member fact ``name`` of the id's aggregated ``flags`` (or its key's ``any_flags``)."""
    return (F.coalesce(F.col(flags), F.lit(0)).bitwiseAND(F.lit(BITS[name]))) != 0


def _history(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Per effective member line: the values the member aggregate needs."""
    paid, day = F.col("order_paid_time"), F.col("date_id")
    clean = F.col("distributor_name") != p.excluded_distributor
    lines = sales_lines(orders, p).where(
        F.col("crm_member_id").isNotNull() & is_true(F.col("if_eff_order_tag"))
        # Lines paid at or after the end change no fact below: they are never
        # the latest purchase before an anchor, and a first purchase that late
        # falls in no window.  The date_id facts look before max(start,
        # ytd_start) only.  Parquet statistics skip the rest when a past
        # period is run again.
        & ((paid < F.lit(p.end)) | (day < F.lit(max(p.start, p.ytd_start)))))
    return lines.select(
        member_key(F.col("crm_member_id")).alias(KEY),
        F.col("crm_member_id").alias(ID),
        # purchase history (all distributors matching the pattern)
        F.when(paid < F.lit(p.start), paid).alias("last_paid_s"),
        F.when(paid < F.lit(p.end), paid).alias("last_paid_e"),
        first_purchase_code(paid, F.col("eff_reg_channel"), p).alias("first_code"),
        _bits(bought_ytd=in_range(paid, p.ytd_start, p.end),
              # effective purchases without the excluded distributor, by date_id
              bought_before_s=clean & (day < F.lit(p.start)),
              in_retain=clean & in_range(day, p.retain_start, p.ytd_start),
              bought_before_rs=clean & (day < F.lit(p.retain_start))),
    )


def _ytd(orders: DataFrame, p: KpiParams) -> DataFrame:
    per_order = ytd_orders(ytd_lines(orders, p), "crm_member_id")
    return per_order.select(
        member_key(F.col("crm_member_id")).alias(KEY),
        F.col("crm_member_id").alias(ID),
        _bits(ytd_shopper=F.col("eff_order")),
        F.when(F.col("eff_order") & F.col("original_order_id").isNotNull(), F.lit(1)).otherwise(F.lit(0))
         .alias("ytd_eff_order"),
        F.col("pos").alias("ytd_pos"),
        F.col("neg").alias("ytd_neg"))


def _joined(members: DataFrame, p: KpiParams) -> DataFrame:
    day = F.to_date("join_time")
    matching = upper_like(F.col("eff_reg_channel"), p.distributor) & F.col("member_detail_id").isNotNull()
    return members.where(matching).select(
        member_key(F.col("member_detail_id")).alias(KEY),
        F.col("member_detail_id").alias(ID),
        _bits(joined_in_period=in_range(day, p.start, p.end), joined_before_s=day < F.lit(p.start)))


def _aggregated(orders: DataFrame, members: DataFrame, p: KpiParams) -> DataFrame:
    """The inputs' values per member id as written: one hash aggregate."""
    parts = (_history(orders, p)
             .unionByName(_ytd(orders, p), allowMissingColumns=True)
             .unionByName(_joined(members, p), allowMissingColumns=True))
    return parts.groupBy(KEY, ID).agg(
        F.max("last_paid_s").alias("last_paid_s"),
        F.max("last_paid_e").alias("last_paid_e"),
        F.min("first_code").alias("first_code"),
        F.bit_or("flags").alias("flags"),
        F.sum("ytd_eff_order").alias("ytd_orders"),
        (F.sum("ytd_pos") - F.sum("ytd_neg")).alias("ytd_sales"),
    )


def _coded(agg: DataFrame, p: KpiParams) -> DataFrame:
    """Recency codes and first-purchase flags in place of the times they follow from."""
    # first_code = 2 * micros(first paid) + other-channel bit (see first_purchase_code)
    first_day = first_code_day(F.col("first_code"))
    return agg.select(
        KEY, ID, "flags",
        bucket_code("last_paid_s", p.start, p.recency_edges).alias("recency_start"),
        bucket_code("last_paid_e", p.end, p.recency_edges).alias("recency_end"),
        (is_true(in_range(first_day, p.start, p.end)) & is_true(first_code_other(F.col("first_code"))))
        .alias("first_other"),
        is_true(in_range(first_day, p.ytd_start, p.start)).alias("is_ytd_first"),
        "ytd_orders", "ytd_sales")


def member_facts(orders: DataFrame, members: DataFrame, p: KpiParams) -> DataFrame:
    """What the inputs say of each member id as written, one row per id: one hash aggregate."""
    return _coded(_aggregated(orders, members, p), p)


def spelled_otherwise() -> F.Column:
    """The id is not written as its key: only then a key can have a second spelling."""
    return F.col(ID) != F.col(KEY).cast("string")


def _facts_of_key(facts: DataFrame) -> DataFrame:
    """Facts with what holds for any row of the key, over ``facts`` with all rows of a key."""
    of_key = Window.partitionBy(KEY)
    return facts.withColumns({
        "any_flags": F.bit_or("flags").over(of_key),
        "any_recency": F.min("recency_start").over(of_key),
        "any_first_other": F.max("first_other").over(of_key),
        "first_of_key": F.min(ID).over(of_key) == F.col(ID),
    })


def _own_facts(facts: DataFrame) -> DataFrame:
    """Facts of keys with one row: the row speaks for the key."""
    return facts.withColumns({"any_flags": F.col("flags"), "any_recency": F.col("recency_start"),
                              "any_first_other": F.col("first_other"), "first_of_key": F.lit(True)})


def _with_key_facts(facts: DataFrame, n_otherwise: int) -> DataFrame:
    """Facts of written ids with their key's, where ``n_otherwise`` ids are not written
    as their key.

    Without any, each key has one row.  A window gathers only the keys such
    an id has; the other rows stay where they are if the keys are few enough
    to broadcast, by their count.
    """
    if not n_otherwise:
        return _own_facts(facts)
    keys = facts.where(spelled_otherwise()).select(KEY).distinct()
    if n_otherwise <= MAX_BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return _facts_of_key(facts.join(keys, KEY, "left_semi")).unionByName(
        _own_facts(facts.join(keys, KEY, "left_anti")))


def member_profile(orders: DataFrame, members: DataFrame, p: KpiParams, mode: str = "table") -> DataFrame:
    """Member-level flags; one row per member id as written.

    The facts are written once (see :mod:`cohortkit.plans.materialize`) and
    the flags computed as they are read.  With ``mode`` ``none`` nothing is
    written, so spellings can't be counted first and a window over the key
    finds them.
    """
    if mode == "none":
        return derive_flags(_aggregated(orders, members, p), p)
    facts = member_facts(orders, members, p)
    if mode == "table":
        seen = Observation()
        facts = write_table(facts, "member_facts",
                            (seen, F.count(F.when(spelled_otherwise(), F.lit(1))).alias("otherwise")))
        n_otherwise = seen.get["otherwise"]
    else:
        facts = materialize(facts, "member_facts", mode)
        n_otherwise = facts.where(spelled_otherwise()).count()
    return _flags(_with_key_facts(facts, n_otherwise))


def derive_flags(agg: DataFrame, p: KpiParams) -> DataFrame:
    """Cohort flags and segment codes of aggregated ids, each key's by a window over it."""
    return _flags(_facts_of_key(_coded(agg, p)))


def _flags(facts: DataFrame) -> DataFrame:
    """Cohort flags and segment codes from the facts of an id and of its key."""
    key_new = has("joined_in_period", "any_flags")
    key_bought = has("bought_before_s", "any_flags")
    key_retain = has("in_retain", "any_flags")
    is_new = has("joined_in_period")
    is_never = has("joined_before_s") & ~key_bought
    is_retain = has("in_retain")
    is_reactivate = has("bought_before_rs") & ~key_retain
    is_other = F.col("first_other") & ~key_new
    key_never = has("joined_before_s", "any_flags") & ~key_bought
    key_reactivate = has("bought_before_rs", "any_flags") & ~key_retain
    key_other = F.col("any_first_other") & ~key_new
    seg_v1 = (F.when(key_new, C[L.NEW_MEMBER])
              .when(key_never, C[L.NEVER_PURCHASED])
              .when(key_retain, C[L.RETAINED])
              .when(key_reactivate, C[L.REACTIVATED])
              .when(key_other, C[L.OTHER_CHANNEL])
              .otherwise(C[L.YTD_SHOPPER]))
    seg_v2 = (F.when(key_new, C[L.NEW_MEMBER])
              .when(key_never, C[L.NEVER_PURCHASED])
              .when(F.col("any_recency").isNotNull(), F.col("any_recency"))
              .when(key_other, C[L.OTHER_CHANNEL]))
    return facts.select(
        KEY, ID, "first_of_key",
        is_new.alias("is_new"),
        is_never.alias("is_never"),
        is_retain.alias("is_retain"),
        is_reactivate.alias("is_reactivate"),
        "is_ytd_first",
        is_other.alias("is_other_channel"),
        "recency_start",
        "recency_end",
        (is_retain & ~has("bought_ytd")).alias("not_retained"),
        (is_reactivate & ~has("bought_ytd")).alias("not_reactivated"),
        has("ytd_shopper").alias("ytd_shopper"),
        (has("ytd_shopper") & (F.coalesce(F.col("ytd_orders"), F.lit(0)) >= 2)).alias("ytd_repeat"),
        F.col("ytd_orders"),
        F.col("ytd_sales"),
        key_new.alias("key_new"),
        key_retain.alias("key_retain"),
        key_reactivate.alias("key_reactivate"),
        key_other.alias("key_other"),
        seg_v1.alias("seg_v1"),
        seg_v2.alias("seg_v2"),
    )
