"""

Each entry pairs a Spark query ``(spark, sf_dir) -> DataFrame`` with the
final SELECT of its DuckDB oracle (run after the report's CTEs, see
:mod:`cohortkit.plans.oracle`).  Every query reads the whole driver tables.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortkit.operators import cohorts, purchases, recency, summaries, ytd
from cohortkit.operators.traffic import traffic_total
from cohortkit.params import KpiParams
from cohortkit.plans import oracle
from cohortkit.plans.weekly import WeeklyKpi
from cohortkit.sources import Tables, tpch_tables

SparkQuery = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    spark: SparkQuery
    oracle_select: str | None  # None: no SQL form, the driver checks rows only
    on_tables: Callable[[Tables, KpiParams], DataFrame] | None = None  # the query on any Tables


PARAMS = KpiParams()
_REGISTRY: dict[str, Query] = {}
# Source frames per session and folder: plans only (file listing and schema),
# no data, so every query still scans its tables in full.
_SOURCES: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def sources(spark: SparkSession, sf_dir: str, agg_type: str) -> Tables:
    per_session = _SOURCES.setdefault(spark, {})
    key = (str(sf_dir).rstrip("/"), agg_type)
    if key not in per_session:
        per_session[key] = tpch_tables(spark, sf_dir, agg_type)
    return per_session[key]


def register(key: str, oracle_select: str | None):
    def wrap(fn: Callable[[Tables, KpiParams], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str, params: KpiParams | None = None) -> DataFrame:
            p = params or PARAMS
            return fn(sources(spark, sf_dir, p.traffic_agg_type), p)
        _REGISTRY[key] = Query(key, run, oracle_select, fn)
        return fn
    return wrap


def _report(t: Tables, p: KpiParams, shared: bool = True) -> WeeklyKpi:
    """The report plan.  ``shared=False`` for a query that only counts over the
    member profile (no join to order lines), where checkpointing it would
    only add a job.  Queries that join the profile to order lines keep the
    checkpoint even when they read it once: with both join sides shuffled,
    AQE can split a member holding a large share of the lines."""
    return WeeklyKpi(t, p, "table" if shared else "none")


def _portable(df: DataFrame) -> DataFrame:
    """Money as double and dates as ISO text in a registered output, so that a
    cross-engine comparison does not hinge on how decimals and dates convert;
    the logical tables themselves keep decimal(18,2) and date."""
    cols = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "decimal":
            cols.append(df[f.name].cast("double").alias(f.name))
        elif f.dataType.typeName() == "date":
            cols.append(df[f.name].cast("string").alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


# --- sources (S1-S3) --------------------------------------------------------

register("src_member_orders",
         "SELECT crm_member_id, eff_reg_channel, original_order_id, order_paid_time, is_rrp_sales_type, "
         "if_eff_order_tag, distributor_name, CAST(date_id AS VARCHAR) AS date_id, sales_qty, "
         "CAST(order_rrp_amt AS DOUBLE) AS order_rrp_amt FROM member_orders")(
    lambda t, p: _portable(t.member_orders))
register("src_members", "SELECT * FROM members")(lambda t, p: t.members)
register("src_store_traffic",
         "SELECT agg_type, CAST(date_id AS VARCHAR) AS date_id, distributor, traffic_amt FROM store_traffic_daily")(
    lambda t, p: _portable(t.store_traffic_daily))

# --- purchase history (A1, A2, W2) -------------------------------------------

register("purchase_events", "SELECT * EXCLUDE (elsewhere) FROM purchases")(
    lambda t, p: purchases.purchase_events(t.member_orders, p))
register("purchase_rank",
         "SELECT * EXCLUDE (elsewhere), CAST(ROW_NUMBER() OVER (PARTITION BY crm_member_id ORDER BY order_paid_time "
         "NULLS LAST, elsewhere, original_order_id NULLS LAST, eff_reg_channel NULLS LAST) AS INTEGER) AS rk FROM purchases")(
    lambda t, p: purchases.purchase_rank(t.member_orders, p))
register("first_purchase",
         "SELECT id AS crm_member_id, opening[1] AS eff_reg_channel, opening[2] AS original_order_id, "
         "opening[3] AS order_paid_time FROM bought")(
    lambda t, p: purchases.first_purchases(t.member_orders, p))

# --- cohorts (A3-A8, A14, A15) -----------------------------------------------

register("new_member_base",
         "SELECT DISTINCT member_detail_id, eff_reg_channel FROM members WHERE UPPER(eff_reg_channel) LIKE '{d}' "
         "AND CAST(join_time AS DATE) BETWEEN DATE '{s}' AND DATE '{e}' - 1")(
    lambda t, p: cohorts.new_member_base(t.members, p))
register("never_purchased_base", "SELECT id AS member_detail_id FROM standing WHERE is_never")(
    lambda t, p: cohorts.never_purchased_base(t.member_orders, t.members, p))
register("retain_base",
         "SELECT DISTINCT crm_member_id, distributor_name FROM line_facts "
         "WHERE counted AND eff AND inside AND in_retain")(
    lambda t, p: cohorts.retain_base(t.member_orders, p))
# NOT EXISTS keeps rows without a member id, as the statement's anti joins do
_EARLY_ROWS = ("SELECT DISTINCT crm_member_id, distributor_name FROM line_facts l "
               "WHERE counted AND eff AND inside AND date_id < DATE '{rs}' "
               "AND NOT EXISTS (SELECT 1 FROM key_standing f WHERE f.k = l.k AND f.is_retain)")
_UNPAID = " AND NOT EXISTS (SELECT 1 FROM bought b WHERE b.id = l.crm_member_id AND b.paid_ytd)"
register("reactivate_base", _EARLY_ROWS)(
    lambda t, p: cohorts.reactivate_base(t.member_orders, p))
register("ytd_first_purchase_base", "SELECT id AS crm_member_id FROM standing WHERE is_ytd_first")(
    lambda t, p: cohorts.ytd_first_purchase_base(t.member_orders, p))
register("other_channel_base", "SELECT id AS crm_member_id FROM standing WHERE is_other")(
    lambda t, p: cohorts.other_channel_base(t.member_orders, t.members, p))
register("not_retained",
         "SELECT DISTINCT crm_member_id FROM line_facts l WHERE counted AND eff AND inside AND in_retain" + _UNPAID)(
    lambda t, p: cohorts.not_retained(t.member_orders, p))
register("not_reactivated", _EARLY_ROWS + _UNPAID)(
    lambda t, p: cohorts.not_reactivated(t.member_orders, p))

# --- recency (A9-A13, A16-A19, AX1) ------------------------------------------

_BUCKET_KEYS = ("0_90", "90_180", "180_270", "270_360", "360_plus")
for _b, _suffix in enumerate(_BUCKET_KEYS):
    register(f"recency_start_{_suffix}", oracle.bucket_select("start", _b))(
        lambda t, p, _b=_b: recency.recency_cohort(t.member_orders, p, p.start, _b))
    if _b:  # the report uses bucket 0 at the start only
        register(f"recency_end_{_suffix}", oracle.bucket_select("end", _b))(
            lambda t, p, _b=_b: recency.recency_cohort(t.member_orders, p, p.end, _b))

_RECENCY_UNION = " UNION ALL ".join(
    f"SELECT id AS crm_member_id, '{anchor}' AS anchor, '{{l_r{b + 1}}}' AS recency_bucket "
    f"FROM person WHERE bucket_{anchor[0]} = {b}" for anchor in ("start", "end") for b in range(5))
register("recency_buckets", _RECENCY_UNION)(
    lambda t, p: recency.recency_buckets(t.member_orders, p))

# --- year to date, traffic (A20, A21) ----------------------------------------

register("ytd_repeat",
         "SELECT id AS crm_member_id, CAST(is_repeat AS INTEGER) AS ytd_repeat, "
         "CAST(IF(is_repeat, ytd_orders, 0) AS BIGINT) AS ytd_repeat_orders, "
         "CAST(IF(is_repeat, ytd_sales, 0) AS DOUBLE) AS ytd_repeat_member_sales FROM standing WHERE ytd_shopper")(
    lambda t, p: ytd.ytd_repeat(t.member_orders, p))
register("traffic_total", "SELECT * FROM traffic")(
    lambda t, p: traffic_total(t.store_traffic_daily, p))

# --- segments and summaries (A22-A28) ----------------------------------------

_SUMMARY_SELECT = ("SELECT member_type, CAST(ttl_sales AS DOUBLE) AS ttl_sales, "
                   "CAST(member_sales AS DOUBLE) AS member_sales, member_shopper, member_orders "
                   "FROM {}")
_ROLLUP_SELECT = ("SELECT member_type, member_base, CAST(ttl_sales AS DOUBLE) AS ttl_sales, "
                  "CAST(member_sales AS DOUBLE) AS member_sales, member_shopper, member_orders "
                  "FROM {}")

register("segmented_lines",
         "SELECT * EXCLUDE (eff, net) REPLACE (CAST(order_rrp_amt AS DOUBLE) AS order_rrp_amt) FROM tagged")(
    lambda t, p: _portable(_report(t, p).segmented_lines))
register("segment_summary", _SUMMARY_SELECT.replace("{}", "seg_summary WHERE v = 1"))(
    lambda t, p: summaries.summary_output(_report(t, p).segment_summary))
register("recency_summary", _SUMMARY_SELECT.replace("{}", "seg_summary WHERE v = 2"))(
    lambda t, p: summaries.summary_output(_report(t, p).recency_summary))
register("member_base_summary", "SELECT * FROM base_counts")(
    lambda t, p: _report(t, p, shared=False).member_base_summary)
register("kpi_rollup", _ROLLUP_SELECT.replace("{}", "rolled WHERE v = 1"))(
    lambda t, p: summaries.rollup_output(_report(t, p).kpi_rollup))
register("recency_base_summary", "SELECT * FROM rec_counts")(
    lambda t, p: _report(t, p, shared=False).recency_base_summary)
register("recency_rollup", _ROLLUP_SELECT.replace("{}", "rolled WHERE v = 2"))(
    lambda t, p: summaries.rollup_output(_report(t, p).recency_rollup))

# --- report (A29-A33) --------------------------------------------------------

register("kpi_segment_final", "SELECT * EXCLUDE (v) FROM finals WHERE v = 1")(
    lambda t, p: _report(t, p).kpi_segment_final)
register("kpi_recency_final", "SELECT * EXCLUDE (v) FROM finals WHERE v = 2")(
    lambda t, p: _report(t, p).kpi_recency_final)
register("kpi_union", "SELECT * EXCLUDE (v) FROM finals")(lambda t, p: _report(t, p).kpi_union)
register("recall_counts", "SELECT * FROM recall")(
    lambda t, p: _report(t, p, shared=False).recall_counts)
register("weekly_kpi",
         "SELECT finals.* EXCLUDE (v), still_need_to_recall FROM finals LEFT JOIN recall USING (member_type)")(
    lambda t, p: _report(t, p).report)


def _load_generic() -> None:
    from cohortkit.operators import generic  # noqa: F401  (registers its keys)


def registry() -> dict[str, Query]:
    _load_generic()
    return dict(_REGISTRY)


def queries() -> dict[str, SparkQuery]:
    return {k: q.spark for k, q in registry().items()}


def oracle_sql(params: KpiParams | None = None) -> dict[str, str]:
    p = params or PARAMS
    return {k: oracle.query(p, q.oracle_select) for k, q in registry().items()
            if q.oracle_select is not None}


__all__ = ["Query", "register", "registry", "queries", "oracle_sql", "PARAMS"]
