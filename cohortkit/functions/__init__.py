from cohortkit.functions import labels
from cohortkit.functions.columns import (
    MONEY,
    day_offset,
    in_range,
    is_true,
    member_key,
    net_sales,
    positive_amount,
    registration_rate,
    returned_amount,
    safe_ratio,
    upper_like,
)

__all__ = [
    "MONEY", "day_offset", "in_range", "is_true", "labels", "member_key",
    "net_sales", "positive_amount", "registration_rate", "returned_amount", "safe_ratio",
    "upper_like",
]
