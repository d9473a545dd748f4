"""Print the final (post-AQE) physical plan of a registered query.

usage: python tools/plan.py KEY [SF_DIR]
"""

import sys

sys.path.insert(0, ".")

from cohortkit.plans.registry import queries  # noqa: E402
from cohortkit.session import local_session  # noqa: E402


def main() -> None:
    key = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    df = queries()[key](spark, sf_dir)
    df._jdf.queryExecution().toRdd().count()  # runs it without gathering rows, so the plan below is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(plan)
    counts = {name: plan.count(name) for name in (
        "Scan parquet", "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
        "BroadcastExchange", "ReusedExchange", "SortAggregate", "HashAggregate", "SortMergeJoin",
        "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Expand")}
    print({k: v for k, v in counts.items() if v})


if __name__ == "__main__":
    main()
