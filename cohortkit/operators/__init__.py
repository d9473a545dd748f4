"""Operators of the report, one module per group of the reference's CTEs.

purchases  A1 purchase history, A2 ranked history, W2 first purchase
ranking    skew-tolerant row number used by A2
cohorts    A3-A8 period cohorts, A14-A15 lapsed cohorts
recency    A9-A13 / A16-A19 recency buckets, AX1 single-pass buckets
ytd        A20 year-to-date (repeat) shoppers
traffic    A21 store traffic
segments   A22 segment-tagged period lines
summaries  A23-A28 segment summaries and cohort sizes
report     A29-A33 ratios and the final report
generic    the single primitives of SURVEY 2.11 as standalone queries
"""
