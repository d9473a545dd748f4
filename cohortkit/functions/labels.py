"""Segment labels of the report.

Fixed values: these strings are the row labels of the report and must equal
the reference's text exactly (they are what a user of the report filters on).
The reference writes two of them once with a trailing blank; the blank is not
"""

# --- fixed values (report labels, in report order) -------------------------
TTL = "0 - ttl"
NEW_MEMBER = "1 - new_member"
EXISTING = "2 - existing"
NEVER_PURCHASED = "3 - existing - never_purchased"
RETAINED = "4 - existing - retained_member"
REACTIVATED = "5 - existing - reactivated_member"
YTD_SHOPPER = "6 - existing - 2024_member_shoppers"
OTHER_CHANNEL = "7 - existing - other_channel_reg_new_belong"
NON_MEMBER = "8 - non_member"
RECENCY_0_90 = "9-1 - existing - 90天内购买"
RECENCY_90_180 = "9-2 - existing - 90天未购"
RECENCY_180_270 = "9-3 - existing - 180天未购"
RECENCY_270_360 = "9-4 - existing - 270天未购"
RECENCY_360_PLUS = "9-5 - existing - 360天以上未购"
NON_MEMBER_V2 = "10 - non_member"
YTD_REPEAT = "YTD repeat purchase"
# ---------------------------------------------------------------------------

RECENCY_LABELS = (RECENCY_0_90, RECENCY_90_180, RECENCY_180_270, RECENCY_270_360, RECENCY_360_PLUS)

# Segment codes.  Lines carry a small integer code through the shuffles and
# the label text is attached only to the few aggregated rows at the end.
SEGMENT_CODES = {
    NEW_MEMBER: 1,
    NEVER_PURCHASED: 3,
    RETAINED: 4,
    REACTIVATED: 5,
    YTD_SHOPPER: 6,
    OTHER_CHANNEL: 7,
    NON_MEMBER: 8,
    RECENCY_0_90: 91,
    RECENCY_90_180: 92,
    RECENCY_180_270: 93,
    RECENCY_270_360: 94,
    RECENCY_360_PLUS: 95,
    NON_MEMBER_V2: 10,
}
CODE_LABELS = {code: label for label, code in SEGMENT_CODES.items()}
RECENCY_CODES = tuple(SEGMENT_CODES[label] for label in RECENCY_LABELS)

# v1 report rows that come from cohort sizes, in union order
BASE_ROWS = (NON_MEMBER, NEW_MEMBER, NEVER_PURCHASED, RETAINED, REACTIVATED, YTD_SHOPPER, OTHER_CHANNEL)
# rows that carry a "still need to recall" count
RECALL_ROWS = (RETAINED, REACTIVATED, RECENCY_90_180, RECENCY_180_270, RECENCY_270_360,
               RECENCY_360_PLUS, YTD_REPEAT)
