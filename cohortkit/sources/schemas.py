"""Logical input schemas (FIXTURES.md section 1) and a conformance check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBER_ORDERS = T.StructType([
    T.StructField("crm_member_id", T.StringType(), True),
    T.StructField("eff_reg_channel", T.StringType(), True),
    T.StructField("original_order_id", T.NullType(), True),  # any type: it is only counted
    T.StructField("order_paid_time", T.TimestampNTZType(), True),
    T.StructField("is_rrp_sales_type", T.IntegerType(), True),
    T.StructField("if_eff_order_tag", T.BooleanType(), True),
    T.StructField("distributor_name", T.StringType(), True),
    T.StructField("date_id", T.DateType(), False),
    T.StructField("sales_qty", T.DoubleType(), True),
    T.StructField("order_rrp_amt", T.DecimalType(18, 2), True),
])

def member_orders_schema(order_id: T.DataType | None = None) -> T.StructType:
    """The order lines' schema with a definite type of the order id."""
    return T.StructType([T.StructField(f.name, order_id or T.LongType(), f.nullable)
                         if isinstance(f.dataType, T.NullType) else f for f in MEMBER_ORDERS])


MEMBERS = T.StructType([
    T.StructField("member_detail_id", T.StringType(), False),
    T.StructField("eff_reg_channel", T.StringType(), True),
    T.StructField("join_time", T.TimestampNTZType(), True),
])

STORE_TRAFFIC_DAILY = T.StructType([
    T.StructField("agg_type", T.StringType(), False),
    T.StructField("date_id", T.DateType(), False),
    T.StructField("distributor", T.StringType(), True),
    T.StructField("traffic_amt", T.DoubleType(), True),
])

SCHEMAS = {
    "member_orders": MEMBER_ORDERS,
    "members": MEMBERS,
    "store_traffic_daily": STORE_TRAFFIC_DAILY,
}


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _keeps_values(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast to ``target`` keeps every value of ``source`` or raises (ANSI)."""
    if isinstance(target, T.StringType):
        return not isinstance(source, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    if isinstance(target, T.DecimalType):
        return isinstance(source, _WHOLE) or (isinstance(source, T.DecimalType) and source.scale <= target.scale)
    if isinstance(target, T.DoubleType):
        return isinstance(source, (*_WHOLE, T.FloatType, T.DecimalType))
    if isinstance(target, T.IntegerType):
        return isinstance(source, (*_WHOLE, T.BooleanType))
    if isinstance(target, T.BooleanType):
        return isinstance(source, (*_WHOLE, T.StringType))
    if isinstance(target, T.TimestampNTZType):
        return isinstance(source, (T.TimestampType, T.DateType, T.StringType))
    return isinstance(target, T.DateType) and isinstance(source, (T.StringType, *_WHOLE))


def conform(df: DataFrame, schema: T.StructType, *, name: str = "input") -> DataFrame:
    """Select the schema's columns in order, casting each to its declared type.

    Missing columns are an error, and so is a type whose values a cast could
    change (an amount with more decimals than the schema's, a day with a time);
    a value that does not fit raises when it is read.  A field of NullType takes
    the source's type as it is; whole-number days are read as yyyymmdd.  Extra
    columns are dropped (column pruning then keeps them out of the scan).
    Only the plan is touched: no data is read here.
    """
    present = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name.lower() not in present]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    cols = []
    for field in schema.fields:
        src = present[field.name.lower()]
        current, wanted = df.schema[src].dataType, field.dataType
        col = F.col(src)
        if current != wanted and not isinstance(wanted, T.NullType):
            if not _keeps_values(current, wanted):
                raise ValueError(f"{name}.{src} is {current.simpleString()}; a cast to {wanted.simpleString()} "
                                 "could change its values")
            if isinstance(wanted, T.DateType) and isinstance(current, _WHOLE):
                col = F.to_date(col.cast("string"), "yyyyMMdd")
            else:
                col = col.cast(wanted)
        cols.append(col.alias(field.name))
    return df.select(*cols)
