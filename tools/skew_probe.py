"""How a hot member spreads over tasks: per-stage task record counts from the event log.

usage: python tools/skew_probe.py [SF_DIR] [KEY ...]

Remaps the driver's tables so that every third customer's orders belong to
one member (about a third of all lines), runs the queries with Spark's event
log written to a fresh scratch folder, and prints for every stage the largest
task's shuffle-read records against the median and the stage total.  A stage
whose largest task reads close to a third of the data would be the skew the
plan must avoid.
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile

import zstandard

sys.path.insert(0, ".")

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortkit.params import KpiParams  # noqa: E402
from cohortkit.plans.registry import registry  # noqa: E402
from cohortkit.session import configure, ensure_checkpoint_dir  # noqa: E402
from cohortkit.sources import Tables, tpch_tables  # noqa: E402


def skewed(t: Tables) -> Tables:
    cust = F.col("crm_member_id").cast("bigint")
    hot = F.when(cust % 3 == 0, F.lit("7")).otherwise(F.col("crm_member_id"))
    return Tables(t.member_orders.withColumn("crm_member_id", hot), t.members, t.store_traffic_daily)


def read_events(log_dir: str) -> list[dict]:
    events = []
    for path in sorted(glob.glob(f"{log_dir}/*/events_*")) + sorted(glob.glob(f"{log_dir}/*.zstd")):
        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        events += [json.loads(line) for line in data.decode().splitlines()]
    return events


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or ["weekly_kpi", "purchase_rank"]
    log_dir = tempfile.mkdtemp(prefix="skew-probe-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             # small splits and no partition coalescing, so that the spread of
             # the work over tasks is visible at test-data size
             .config("spark.sql.files.maxPartitionBytes", str(512 * 1024))
             .config("spark.sql.files.openCostInBytes", "0")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ensure_checkpoint_dir(spark)
    t = skewed(tpch_tables(spark, sf_dir))
    share = t.member_orders.agg(F.avg((F.col("crm_member_id") == "7").cast("int"))).first()[0]
    print(f"hot member share of all lines: {share:.2f}")
    for key in keys:
        spark.sparkContext.setJobGroup(key, key)
        registry()[key].on_tables(t, KpiParams()).write.format("noop").mode("overwrite").save()
    spark.stop()

    tasks, stage_group, stage_name = {}, {}, {}
    job_group = {}
    for e in read_events(log_dir):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            grp = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_group[s] = grp
        elif ev == "SparkListenerStageSubmitted":
            stage_name[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"]
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            shuffle = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            read = m.get("Input Metrics", {}).get("Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append((shuffle, read))
    print("shuffle-read records per task (input scans are listed apart: their spread follows the")
    print("files' row groups, not the plan)")
    print(f"{'group':<16}{'stage':>6}{'tasks':>7}{'max':>10}{'median':>10}{'total':>11}{'max/total':>11}"
          f"{'input':>10}")
    for s in sorted(tasks):
        shuffled = [a for a, _ in tasks[s]]
        total = sum(shuffled)
        read = sum(b for _, b in tasks[s])
        if total < 1000:
            continue
        print(f"{str(stage_group.get(s)):<16}{s:>6}{len(shuffled):>7}{max(shuffled):>10}"
              f"{int(statistics.median(shuffled)):>10}{total:>11}{max(shuffled) / total:>11.2f}{read:>10}")


if __name__ == "__main__":
    main()
