"""Column expressions shared by the operators.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none needs a Python worker.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed exactly as decimal and turned into double only for output.
MONEY = "decimal(18,2)"


def day_offset(anchor: dt.date, days: int) -> Column:
    """``anchor - days`` as a DATE literal (the reference's ``'{}' - 90``)."""
    return F.lit(anchor - dt.timedelta(days=days))


def in_range(col: Column, lo, hi) -> Column:
    """Half-open range ``lo <= col < hi``; either bound may be ``None``."""
    cond = None
    if lo is not None:
        cond = col >= (lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        upper = col < (hi if isinstance(hi, Column) else F.lit(hi))
        cond = upper if cond is None else cond & upper
    return F.lit(True) if cond is None else cond


def is_true(col: Column) -> Column:
    """SQL ``IS TRUE``: NULL counts as false."""
    return F.coalesce(col, F.lit(False))


def upper_like(col: Column, pattern: str) -> Column:
    """``UPPER(col) LIKE pattern``; the pattern itself is not upper-cased."""
    return F.upper(col).like(pattern)


def member_key(col: Column) -> Column:
    """Integer member key; ids are compared as integers, as the reference's joins do."""
    return col.cast("bigint")


def positive_amount(amt: Column, qty: Column, cond: Column | None = None) -> Column:
    """Per-line part of net sales that adds: amount of lines with quantity > 0."""
    test = qty > 0 if cond is None else cond & (qty > 0)
    return F.when(test, amt).otherwise(F.lit(0).cast(MONEY))


def returned_amount(amt: Column, qty: Column, cond: Column | None = None) -> Column:
    """Per-line part of net sales that subtracts: ``abs`` amount of lines with quantity < 0."""
    test = qty < 0 if cond is None else cond & (qty < 0)
    return F.when(test, F.abs(amt)).otherwise(F.lit(0).cast(MONEY))


def net_sales(amt: Column, qty: Column, cond: Column | None = None) -> Column:
    """Aggregate: sales of positive-quantity lines minus ``abs`` of returned lines.

    Zero-quantity lines add nothing; the sum over no rows is NULL.
    """
    return F.sum(positive_amount(amt, qty, cond)) - F.sum(returned_amount(amt, qty, cond))


def safe_ratio(num: Column, den: Column) -> Column:
    """``coalesce(double(num) / nullif(den, 0), 0)``."""
    return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)), F.lit(0.0))


def registration_rate(base: Column, traffic: Column) -> Column:
    """``round(double(base) / nullif(traffic, 0), 4)``; NULL when there is no traffic."""
    return F.round(base.cast("double") / F.nullif(traffic, F.lit(0.0)), 4)


_EPOCH = dt.date(1970, 1, 1)


def ntz_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session
    time zone (day number plus the wall-clock time of day)."""
    days = F.datediff(F.to_date(ts), F.lit(_EPOCH)).cast("bigint")
    secs = F.date_part(F.lit("SECOND"), ts)  # seconds with fraction, decimal(8,6)
    return (days * F.lit(86_400_000_000) + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(ts).cast("bigint") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("bigint"))

