"""cohortkit: member cohort KPI reports on Spark DataFrames.

    from cohortkit import KpiParams, read_tables, weekly_kpi
    report = weekly_kpi(read_tables(spark, fact, members, traffic), KpiParams(...))
"""

from cohortkit.params import DEFAULT_PARAMS, KpiParams
from cohortkit.plans.weekly import WeeklyKpi, weekly_kpi
from cohortkit.session import configure, local_session
from cohortkit.sources import Tables, read_tables, tpch_tables

__all__ = ["KpiParams", "DEFAULT_PARAMS", "WeeklyKpi", "weekly_kpi", "configure", "local_session",
           "Tables", "read_tables", "tpch_tables"]
