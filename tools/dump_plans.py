"""Write the physical plans of the flagship to docs/weekly_kpi_plans.txt.

usage: python tools/dump_plans.py [SF_DIR]

The report runs in two parts: the member profile (written as a table), then the
report over it (period join, segment summaries, counts, traffic, labelled
tail).  Each plan is Spark's formatted explain of the initial physical plan
(before AQE's runtime changes).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, ".")

from cohortkit.params import KpiParams  # noqa: E402
from cohortkit.plans.member_profile import member_profile  # noqa: E402
from cohortkit.plans.registry import sources  # noqa: E402
from cohortkit.plans.weekly import WeeklyKpi  # noqa: E402
from cohortkit.session import local_session  # noqa: E402


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    t = sources(spark, sf_dir, "STORE")
    p = KpiParams()
    w = WeeklyKpi(t, p)
    parts = [
        ("1. member profile (one hash aggregate over history, YTD orders and members, a window over the key; written as a table)",
         member_profile(t.member_orders, t.members, p)),
        ("2. report over the written profile (period read once, one join, one Expand aggregate "
         "for both segment summaries, cohort counts, traffic, grouping sets and label joins over "
         "at most 30 rows)", w.report),
    ]
    out = [f"Physical plans of weekly_kpi on {os.path.basename(sf_dir)} (local[*], 16 shuffle partitions)\n"]
    for title, df in parts:
        out.append("=" * 100 + f"\n{title}\n" + "=" * 100 + "\n" + explain(df))
    os.makedirs("docs", exist_ok=True)
    with open("docs/weekly_kpi_plans.txt", "w") as fh:
        fh.write("\n".join(out))
    print("wrote docs/weekly_kpi_plans.txt")


if __name__ == "__main__":
    main()
