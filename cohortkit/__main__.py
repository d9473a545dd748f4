"""Run the weekly KPI report from the command line (``spark-submit`` or ``python -m``).

    python -m cohortkit --member-orders PATH --members PATH --store-traffic PATH \\
        --distributor BUILDING --start 2024-01-08 --end 2024-01-15 \\
        --retain-start 2023-01-01 --ytd-start 2024-01-01 --out PATH

``--tpch-dir DIR`` reads the driver's TPC-H-style tables through the test
mapping instead of the three logical tables.  Without ``--out`` the report
is shown (15 rows at most); with it, it is written as parquet (or csv).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cohortkit.params import KpiParams
from cohortkit.plans.materialize import run_folder
from cohortkit.plans.weekly import weekly_kpi
from cohortkit.session import configure
from cohortkit.sources import read_tables, tpch_tables


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="cohortkit", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tpch-dir", help="folder with the driver's TPC-H-style parquet tables")
    src.add_argument("--member-orders", help="parquet path of the order-line fact")
    ap.add_argument("--members", help="parquet path of the member dimension")
    ap.add_argument("--store-traffic", help="parquet path of the store-day traffic")
    ap.add_argument("--distributor", default="BUILDING", help="LIKE pattern of the distributor")
    ap.add_argument("--start", required=True)
    ap.add_argument("--end", required=True)
    ap.add_argument("--retain-start", required=True)
    ap.add_argument("--ytd-start", required=True)
    ap.add_argument("--excluded-distributor", default="LBR")
    ap.add_argument("--traffic-agg-type", default="STORE")
    ap.add_argument("--out", help="output path; the report is shown when absent")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    args = ap.parse_args(argv)
    if args.member_orders and not (args.members and args.store_traffic):
        ap.error("--member-orders needs --members and --store-traffic")
    return args


def main(argv=None) -> None:
    args = parse_args(argv)
    params = KpiParams(distributor=args.distributor, start=args.start, end=args.end,
                       retain_start=args.retain_start, ytd_start=args.ytd_start,
                       excluded_distributor=args.excluded_distributor,
                       traffic_agg_type=args.traffic_agg_type)
    spark = configure(SparkSession.builder.appName("cohortkit-weekly-kpi").getOrCreate())
    if args.tpch_dir:
        tables = tpch_tables(spark, args.tpch_dir, params.traffic_agg_type)
    else:
        tables = read_tables(spark, args.member_orders, args.members, args.store_traffic)
    with run_folder(spark):  # the member profile's table goes when the report is out
        report = weekly_kpi(tables, params)
        if args.out:
            writer = report.coalesce(1).write.mode("overwrite")
            (writer.option("header", True).csv(args.out) if args.format == "csv" else writer.parquet(args.out))
        else:
            report.show(truncate=False)


if __name__ == "__main__":
    main()
