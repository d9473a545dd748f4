"""Typed parameters of one KPI run.

The report is defined by one distributor pattern and one half-open period
``[start, end)``; the cohort definitions also need the start of the retention
year and of the current year.  Every value is a typed literal, so nothing is
spliced into SQL text.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class KpiParams:
    # ``LIKE`` pattern matched against the distributor (case-sensitive) and
    # against the upper-cased registration channel.
    distributor: str = "BUILDING"
    # report period, half-open
    start: dt.date = dt.date(2000, 10, 1)
    end: dt.date = dt.date(2001, 1, 1)
    # purchases in [retain_start, ytd_start) make a member "retained";
    # purchases before retain_start only make them "reactivated"
    retain_start: dt.date = dt.date(1999, 1, 1)
    # first day of the year-to-date window
    ytd_start: dt.date = dt.date(2000, 1, 1)
    # distributor left out of every cohort except the purchase history
    excluded_distributor: str = "LBR"
    # ``agg_type`` value of the store traffic rows to use
    traffic_agg_type: str = "STORE"
    # recency bucket edges in days before the anchor date
    recency_edges: tuple[int, int, int, int] = field(default=(90, 180, 270, 360))

    def __post_init__(self) -> None:
        for name in ("start", "end", "retain_start", "ytd_start"):
            value = getattr(self, name)
            if isinstance(value, str):
                object.__setattr__(self, name, dt.date.fromisoformat(value))
            elif isinstance(value, dt.datetime):
                if value.time() != dt.time(0):
                    raise ValueError(f"{name} must be a day; {value} has a time of day")
                object.__setattr__(self, name, value.date())
            elif not isinstance(value, dt.date):
                raise TypeError(f"{name} must be a date, got {type(value).__name__}")
        if not self.start < self.end:
            raise ValueError("start must be before end")
        if not self.retain_start <= self.ytd_start:
            raise ValueError("retain_start must not be after ytd_start")
        edges = tuple(int(e) for e in self.recency_edges)
        if len(edges) != 4 or any(e <= 0 for e in edges) or list(edges) != sorted(set(edges)):
            raise ValueError("recency_edges must be four increasing positive day counts")
        object.__setattr__(self, "recency_edges", edges)
        if not self.distributor:
            raise ValueError("distributor pattern must not be empty")

    def replace(self, **changes) -> "KpiParams":
        values = {k: getattr(self, k) for k in self.__dataclass_fields__}
        values.update(changes)
        return KpiParams(**values)


DEFAULT_PARAMS = KpiParams()
