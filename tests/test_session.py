import pytest

import __spark_entry__
from cohortkit import session
from cohortkit.session import ADVISORY_SIZE, MAX_ADVISORY_BYTES, _bytes, configure

# queries over the line-order join whose task memory the cap bounds
LINE_ORDER_QUERIES = (
    "purchase_events", "ytd_first_purchase_base", "case_first_match", "group_null_label", "join_flag",
    "member_base_summary", "recall_counts", "recency_base_summary", "segmented_lines", "union_labelled",
    "reactivate_base", "flag_max_having", "join_anti", "never_purchased_base", "recency_end_180_270",
    "recency_end_270_360")


@pytest.fixture
def conf(spark):
    """The session's settings; those a test changes come back."""
    keys = (ADVISORY_SIZE, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k) for k in keys}
    yield spark.conf
    for k, v in old.items():
        spark.conf.set(k, v)


def test_size_settings_are_read_as_spark_writes_them():
    assert [_bytes(s) for s in ("1024", "16k", "8m", "64MB", "67108864b", "1g")] == [
        1024, 16 << 10, 8 << 20, 64 << 20, 64 << 20, 1 << 30]


def test_advisory_size_is_lowered_never_raised(spark, conf):
    for given, kept in (("64MB", MAX_ADVISORY_BYTES), ("1g", MAX_ADVISORY_BYTES), ("8m", 8 << 20), ("16k", 16 << 10)):
        conf.set(ADVISORY_SIZE, given)
        configure(spark)
        assert _bytes(conf.get(ADVISORY_SIZE)) == kept, given
    conf.unset(ADVISORY_SIZE)  # Spark's own 64 MB
    configure(spark)
    assert _bytes(conf.get(ADVISORY_SIZE)) == MAX_ADVISORY_BYTES


def test_a_join_of_narrow_rows_is_not_coalesced_into_one_task(spark, conf):
    # some 20 MB of compressed shuffle, below Spark's own advisory size, hold
    # 4 million rows to sort
    conf.unset(ADVISORY_SIZE)
    configure(spark)
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf.set("spark.sql.shuffle.partitions", "32")
    joined = spark.range(2_000_000).join(spark.range(2_000_000), "id")
    assert joined.rdd.getNumPartitions() > 1
    assert joined.count() == 2_000_000


@pytest.fixture(scope="module")
def line_tables(spark, tmp_path_factory):
    """60,000 lines of 15,000 orders of 1,000 customers."""
    at = str(tmp_path_factory.mktemp("lines"))
    day = "cast(date_add(DATE'1995-01-01', cast(id * 7 % 1400 as int)) as timestamp_ntz)"
    tables = {
        "lineitem": (60_000, "id div 4 as l_orderkey", "cast(id % 4 + 1 as int) as l_linenumber",
                     "id % 10 as l_suppkey", "double(id % 50 + 1) as l_quantity",
                     "double(id % 1000 + 1) as l_extendedprice", "if(id % 9 = 0, 'R', 'N') as l_returnflag",
                     f"{day} as l_shipdate"),
        "orders": (15_000, "id as o_orderkey", "id * 31 % 1000 as o_custkey", "'F' as o_orderstatus",
                   f"{day} as o_orderdate", "'1-URGENT' as o_orderpriority"),
        "customer": (1_000, "id as c_custkey", "'BUILDING' as c_mktsegment"),
    }
    for name, (n, *columns) in tables.items():
        spark.range(0, n, 1, 1).selectExpr(*columns).write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.mark.parametrize("name", LINE_ORDER_QUERIES)
def test_line_order_queries_run_under_the_cap(spark, conf, line_tables, name):
    conf.unset(ADVISORY_SIZE)  # Spark's own 64 MB
    df = __spark_entry__.queries()[name](spark, line_tables)
    assert df.columns
    assert _bytes(conf.get(ADVISORY_SIZE)) <= MAX_ADVISORY_BYTES


def test_the_line_order_join_is_cut_by_the_cap(spark, conf, line_tables, monkeypatch, request):
    # some 200 KB of compressed shuffle: one task by Spark's own advisory size
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    request.addfinalizer(lambda: conf.unset(least))
    conf.set(least, "1k")
    monkeypatch.setattr(session, "MAX_ADVISORY_BYTES", 32 << 10)
    conf.unset(ADVISORY_SIZE)
    conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")  # customer is below it
    conf.set("spark.sql.shuffle.partitions", "64")
    df = __spark_entry__.queries()["purchase_events"](spark, line_tables)
    assert df.rdd.getNumPartitions() > 3
    assert df.count() == 15_000 * 9 // 10  # every tenth customer is no member
