"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed in
full into a noop sink; nothing is collected to the driver.  Each query runs
once to warm up, then ``$BENCH_RUNS`` (default 5) times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortkit.plans import registry  # noqa: E402
from cohortkit.plans.materialize import run_folder  # noqa: E402
from cohortkit.session import local_session  # noqa: E402

HEADLINE = (
    "weekly_kpi",
    "segmented_lines",
    "segment_summary",
    "kpi_rollup",
    "purchase_rank",
    "first_purchase",
    "recency_buckets",
    "never_purchased_base",
    "reactivate_base",
    "not_reactivated",
    "ytd_repeat",
    "traffic_total",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # shuffle partitions sized to the data: at sf0.1 one per core (a cluster sets its own)
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = local_session(cores=cpus, shuffle_partitions=parts, app="cohortkit-bench", memory="16g")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    qs = registry.queries()
    failed = {}
    for key in HEADLINE:  # warm-up: JVM, codegen, file cache
        try:
            with run_folder(spark):
                run(qs[key](spark, sf_dir))
        except Exception as exc:  # a failing query is reported, the others still run
            failed[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {}
    for key in HEADLINE:
        if key in failed:
            continue
        samples = []
        for _ in range(runs):
            spark.catalog.clearCache()
            with run_folder(spark):
                t0 = time.perf_counter()
                run(qs[key](spark, sf_dir))
                samples.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "flagship": "weekly_kpi",
        "cpus": int(cpus),
        "runs": runs,
        "stat": "median",
        "shuffle_partitions": parts,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
