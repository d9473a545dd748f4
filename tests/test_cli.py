import glob
import os
import subprocess
import sys
import tempfile

import pytest

from cohortkit.__main__ import main
from cohortkit.plans.materialize import drop, materialize, owner, run_folder
from cohortkit.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_cli_writes_the_report(spark):
    out = tempfile.mkdtemp(prefix="cohortkit-cli-") + "/report"
    main(["--tpch-dir", SF, "--start", "2000-10-01", "--end", "2001-01-01",
          "--retain-start", "1999-01-01", "--ytd-start", "2000-01-01", "--out", out])
    df = spark.read.parquet(out)
    assert df.count() == 15
    assert "still_need_to_recall" in df.columns


def _left(spark) -> list[str]:
    return glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/cohortkit-run-*/*")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_a_run_leaves_no_table_behind(spark, capsys):
    before = set(_left(spark))
    main(["--tpch-dir", SF, "--start", "2000-10-01", "--end", "2001-01-01",
          "--retain-start", "1999-01-01", "--ytd-start", "2000-01-01"])
    assert "still_need_to_recall" in capsys.readouterr().out
    assert set(_left(spark)) == before


def test_tables_go_with_their_owner(spark):
    df = spark.range(10)
    with run_folder(spark) as outer:
        kept = materialize(df, "numbers")
        with pytest.raises(RuntimeError), run_folder(spark) as inner:
            materialize(df, "numbers")
            raise RuntimeError
        assert not os.path.exists(inner.path.removeprefix("file:"))
        assert kept.count() == 10 and outer.path in kept.inputFiles()[0]
    assert not os.path.exists(outer.path.removeprefix("file:"))
    # outside a block the application owns the table
    free = materialize(df, "numbers")
    assert owner(spark).path in free.inputFiles()[0]
    drop(free)


def test_tables_of_the_application_go_with_its_jvm():
    code = ("from cohortkit.session import local_session; from cohortkit.plans.materialize import materialize, owner; "
            "s = local_session(1, 1); materialize(s.range(3), 'numbers'); print(owner(s).path); s.stop()")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = out.stdout.strip().splitlines()[-1].removeprefix("file:")
    assert "cohortkit-run-" in path and not os.path.exists(path)


def test_cli_needs_all_three_tables():
    with pytest.raises(SystemExit):
        main(["--member-orders", "x", "--start", "2000-10-01", "--end", "2001-01-01",
              "--retain-start", "1999-01-01", "--ytd-start", "2000-01-01"])


def test_cli_reads_logical_tables(spark):
    import fixtures as fx

    t = fx.spark_tables(spark)
    root = tempfile.mkdtemp(prefix="cohortkit-cli-tables-")
    t.member_orders.write.partitionBy("date_id").parquet(f"{root}/orders")
    t.members.write.parquet(f"{root}/members")
    t.store_traffic_daily.write.parquet(f"{root}/traffic")
    p = fx.PARAMS
    main(["--member-orders", f"{root}/orders", "--members", f"{root}/members",
          "--store-traffic", f"{root}/traffic", "--distributor", p.distributor,
          "--start", str(p.start), "--end", str(p.end), "--retain-start", str(p.retain_start),
          "--ytd-start", str(p.ytd_start), "--out", f"{root}/report", "--format", "csv"])
    out = spark.read.option("header", True).csv(f"{root}/report")
    assert out.count() == 15
