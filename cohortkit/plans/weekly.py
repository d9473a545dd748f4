"""The weekly KPI report: the member profile job, then the report over it.

Data flow (shuffles in brackets, checkpoints in double brackets):

    order fact --+-- effective history -----+
                 +-- [YTD (member, order)] --+--[member_key]-- member profile ((1))
    members ------------------------------+
    order fact -- [period (member, order)] --[member_key join with (1)]--
        [segment, distinct value] -- segment summaries, v1 and v2 (2)
    (1) -- one global aggregate -- cohort / recency / recall / YTD counts
    store traffic -- one global aggregate
    (2) + counts => at most 30 labelled rows, joined by label (broadcast),
                    subtotal and total as grouping sets

The order fact is scanned three times (whole history, YTD window, period),
against nine in the reference; the windows prune partitions when the fact is
partitioned by ``date_id``.  The profile job runs when the profile is first used, that is
while a frame that needs it is being built; the report over it is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from cohortkit.operators import report, summaries
from cohortkit.operators.segments import order_grain, segmented_lines
from cohortkit.operators.traffic import traffic_total
from cohortkit.params import KpiParams
from cohortkit.plans.materialize import drop
from cohortkit.plans.member_profile import member_profile
from cohortkit.sources import Tables


@dataclass
class WeeklyKpi:
    """Lazy frames of one report run; each property is a step of the plan."""

    tables: Tables
    params: KpiParams
    # how the member profile is shared by its readers (see plans.materialize)
    materialize: str = "table"

    @cached_property
    def profile(self) -> DataFrame:
        return member_profile(self.tables.member_orders, self.tables.members, self.params, self.materialize)

    def release(self) -> None:
        """Remove the facts written for the profile (the frames built on it can't be read any more)."""
        if self.materialize == "table" and "profile" in self.__dict__:
            drop(self.profile)

    @cached_property
    def order_grain(self) -> DataFrame:
        return order_grain(self.tables.member_orders, self.profile, self.params)

    @cached_property
    def segmented_lines(self) -> DataFrame:
        return segmented_lines(self.tables.member_orders, self.profile, self.params)

    @cached_property
    def segment_summaries(self) -> DataFrame:
        # at most 2 x 15 rows, read once (by the rollups' grouping sets)
        return summaries.segment_summaries(self.order_grain)

    @cached_property
    def segment_summary(self) -> DataFrame:
        return summaries.segment_summary(self.segment_summaries, 1)

    @cached_property
    def recency_summary(self) -> DataFrame:
        return summaries.segment_summary(self.segment_summaries, 2)

    @cached_property
    def counts(self) -> DataFrame:
        return summaries.cohort_counts(self.profile)

    @cached_property
    def labelled_counts(self) -> DataFrame:
        return summaries.labelled_counts(self.counts)

    @cached_property
    def member_base_summary(self) -> DataFrame:
        return summaries.member_base_summary(self.labelled_counts)

    @cached_property
    def recency_base_summary(self) -> DataFrame:
        return summaries.recency_base_summary(self.labelled_counts)

    @cached_property
    def recall_counts(self) -> DataFrame:
        return summaries.recall_counts(self.labelled_counts)

    @cached_property
    def traffic(self) -> DataFrame:
        return traffic_total(self.tables.store_traffic_daily, self.params)

    @cached_property
    def rollups(self) -> DataFrame:
        return summaries.rollups(self.labelled_counts, self.segment_summaries)

    @cached_property
    def kpi_rollup(self) -> DataFrame:
        return summaries.rollup(self.rollups, 1)

    @cached_property
    def recency_rollup(self) -> DataFrame:
        return summaries.rollup(self.rollups, 2)

    @cached_property
    def kpi_final(self) -> DataFrame:
        return report.kpi_final(self.rollups, self.traffic)

    @cached_property
    def kpi_segment_final(self) -> DataFrame:
        return report.kpi_version(self.kpi_final, 1)

    @cached_property
    def kpi_recency_final(self) -> DataFrame:
        return report.kpi_version(self.kpi_final, 2)

    @cached_property
    def kpi_union(self) -> DataFrame:
        return report.kpi_union(self.kpi_final)

    @cached_property
    def report(self) -> DataFrame:
        return report.weekly_kpi_report(self.kpi_union, self.recall_counts)


def weekly_kpi(tables: Tables, params: KpiParams | None = None,
               materialize: str = "table") -> DataFrame:
    """The report: up to 15 rows x 11 columns, in no particular order.

    Building the frame runs the profile job (unless ``materialize`` is ``none``
    or ``persist``).  Its table goes when the enclosing ``run_folder`` block or
    the application ends; :class:`WeeklyKpi` has ``release`` for it.
    """
    return WeeklyKpi(tables, params or KpiParams(), materialize).report
