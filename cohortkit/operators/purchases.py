"""Purchase history of members (A1, A2) and the first purchase."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.functions.columns import is_true, ntz_micros, upper_like
from cohortkit.operators.ranking import row_number_within
from cohortkit.params import KpiParams

_EPOCH = dt.date(1970, 1, 1)
_DAY_MICROS = 86_400_000_000
PURCHASE_COLS = ("crm_member_id", "eff_reg_channel", "original_order_id", "order_paid_time")


def sales_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Lines of the sales type the report counts, at distributors matching the pattern."""
    return orders.where((F.col("is_rrp_sales_type") == 1) & F.col("distributor_name").like(p.distributor))


def effective_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Sales lines of effective orders (``if_eff_order_tag IS TRUE``)."""
    return sales_lines(orders, p).where(is_true(F.col("if_eff_order_tag")))


def clean_effective_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Effective lines without the excluded distributor (NULL distributor drops too)."""
    return effective_lines(orders, p).where(F.col("distributor_name") != p.excluded_distributor)


def purchase_lines(orders: DataFrame, p: KpiParams) -> DataFrame:
    """A1 before its ``DISTINCT``: effective member lines, purchase columns only.

    Readers that only take ``max``/``min`` or distinct keys of the history use
    this directly; the ``DISTINCT`` would cost a shuffle without changing them.
    """
    return (effective_lines(orders, p)
            .where(F.col("crm_member_id").isNotNull())
            .select(*PURCHASE_COLS))


def purchase_events(orders: DataFrame, p: KpiParams) -> DataFrame:
    """A1: effective member purchases, one row per (member, channel, order, paid time)."""
    return purchase_lines(orders, p).distinct()


def other_channel(channel: Column, p: KpiParams) -> Column:
    """The registration channel does not match the pattern (NULL channel: false)."""
    return is_true(~upper_like(channel, p.distributor))


def purchase_order(p: KpiParams) -> list[Column]:
    """Order of a member's purchases: paid time (NULL last), then purchases through a
    matching channel first, then order id and channel.

    The reference orders by paid time only, which leaves the first purchase
    undefined when a member pays two orders at the same instant; the
    tie-breaks make it defined.  Putting the channel test first among them
    lets the member aggregate find the first purchase's channel test from one
    fixed-width ``min`` (see :func:`first_purchase_code`).
    """
    return [F.col("order_paid_time").asc_nulls_last(),
            other_channel(F.col("eff_reg_channel"), p).asc(),
            F.col("original_order_id").asc_nulls_last(),
            F.col("eff_reg_channel").asc_nulls_last()]


def purchase_hour(paid: Column) -> Column:
    """Hour number of the paid time (wall clock, no time zone), NULL last: never
    decreases along :func:`purchase_order`."""
    days = F.datediff(F.to_date(paid), F.lit(_EPOCH)).cast("bigint")
    return F.coalesce(days * F.lit(24) + F.hour(paid).cast("bigint"), F.lit(2**62))


def second_of_hour(paid: Column) -> Column:
    """Second within the hour of the paid time, 0 for NULL."""
    return F.coalesce(F.minute(paid) * F.lit(60) + F.second(paid), F.lit(0))


def order_range(order: Column, dtype: T.DataType) -> Column:
    """A coarse position of an order id, NULL last, that never decreases along it:
    ranges of 4,096 for numbers, the first 12 characters of a string."""
    if isinstance(dtype, T.IntegralType):
        coarse = F.shiftright(order.cast("bigint"), 12)
    elif isinstance(dtype, T.NumericType):
        coarse = F.floor(order / F.lit(4096))
    else:
        coarse = F.substring(order.cast("string"), 1, 12)
    return F.struct(order.isNull().alias("missing"), coarse.alias("range"))


def purchase_rank(orders: DataFrame, p: KpiParams) -> DataFrame:
    """A2: A1 plus ``rk``, the position of each purchase in its member's history.

    Numbered per (member, instant, channel test, range of order ids) and offset
    by the counts of earlier slices, so a member with a very long history, with
    a great many purchases in one hour, or at one instant, is spread over many
    tasks.
    """
    paid = F.col("order_paid_time")
    micros = F.coalesce(F.pmod(ntz_micros(paid), F.lit(1_000_000)), F.lit(0))
    dtype = orders.schema["original_order_id"].dataType
    tie = F.struct(micros.alias("micros"), other_channel(F.col("eff_reg_channel"), p).alias("other"),
                   order_range(F.col("original_order_id"), dtype).alias("orders"))
    return row_number_within(purchase_events(orders, p), ["crm_member_id"], purchase_order(p),
                             [purchase_hour(paid), second_of_hour(paid), tie], "rk")


def first_purchase_code(paid: Column, channel: Column, p: KpiParams) -> Column:
    """``2 * micros(paid) + other_channel``: its minimum over a member's purchases
    has the first paid time and, in its low bit, whether the first purchase
    (under :func:`purchase_order`) was through another channel.  A long, so
    the member aggregate stays a hash aggregate."""
    return F.when(paid.isNotNull(),
                  ntz_micros(paid) * F.lit(2) + other_channel(channel, p).cast("bigint"))


def first_code_day(code: Column) -> Column:
    """Day of the first purchase from a :func:`first_purchase_code` minimum."""
    micros = F.shiftright(code, 1)
    days = ((micros - F.pmod(micros, F.lit(_DAY_MICROS))) / F.lit(_DAY_MICROS)).cast("int")
    return F.date_add(F.lit(_EPOCH), days)


def first_code_other(code: Column) -> Column:
    """Whether the first purchase was through another channel (the code's low bit)."""
    return F.pmod(code, F.lit(2)) == 1


def first_codes(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Per member (raw id): the minimum :func:`first_purchase_code` of its history.

    A hash aggregate on a long that combines map-side; enough for every use
    that needs only the first purchase's day and channel test.
    """
    paid, channel = F.col("order_paid_time"), F.col("eff_reg_channel")
    return purchase_lines(orders, p).groupBy("crm_member_id").agg(
        F.min(first_purchase_code(paid, channel, p)).alias("first_code"))


def first_purchase_key(paid: Column, order: Column, channel: Column, p: KpiParams) -> Column:
    """Struct whose minimum is the first purchase under :func:`purchase_order`.

    Struct comparison puts NULL fields first, so each nullable field is
    preceded by its own is-null flag to sort NULLs last.
    """
    return F.struct(paid.isNull().alias("paid_null"), paid.alias("order_paid_time"),
                    other_channel(channel, p).alias("other_channel"),
                    order.isNull().alias("order_null"), order.alias("original_order_id"),
                    channel.isNull().alias("channel_null"), channel.alias("eff_reg_channel"))


def first_purchases(orders: DataFrame, p: KpiParams) -> DataFrame:
    """Each member's first purchase (the ``rk = 1`` row of A2).

    Computed as a ``min`` of a struct, an aggregate that combines map-side, so
    a member with a very long history costs one row per task in the shuffle
    instead of a whole window partition.  (The struct holds strings, so this
    aggregate is sort-based; the member profile, which needs only the paid
    time and the channel test, uses a fixed-width code instead.)
    """
    ev = purchase_lines(orders, p)  # min ignores repeated rows
    first = (ev.groupBy("crm_member_id")
             .agg(F.min(first_purchase_key(F.col("order_paid_time"), F.col("original_order_id"),
                                           F.col("eff_reg_channel"), p)).alias("f")))
    return first.select("crm_member_id", F.col("f.eff_reg_channel").alias("eff_reg_channel"),
                        F.col("f.original_order_id").alias("original_order_id"),
                        F.col("f.order_paid_time").alias("order_paid_time"))
