"""Spark session settings the engine relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs, whatever the cluster: UTC so that date/time
# literals mean the same everywhere, AQE for runtime coalescing and skew
# splitting of the member-keyed joins; coalescing by the advisory partition
# size rather than by parallelism, as Spark recommends for busy clusters (no
# swarm of tiny tasks after the selective period and label steps).  That size
# is capped by MAX_ADVISORY_BYTES.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # a member id that is no number raises, as an integer cast of it would, and
    # does not turn its lines into non-member lines
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# The advisory size counts compressed shuffle bytes.  The line-order join's narrow
# rows take some 16 times as much in the sorts of one task: Spark's 64 MB is 1 GB
# there, however many partitions the cluster has.  A smaller setting is kept.
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MAX_ADVISORY_BYTES = 8 * 1024 * 1024


def _bytes(size: str) -> int:
    """The bytes of a Spark size setting (``64MB``, ``8m``, ``67108864b``, ``1024``)."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    if _bytes(spark.conf.get(ADVISORY_SIZE)) > MAX_ADVISORY_BYTES:
        spark.conf.set(ADVISORY_SIZE, f"{MAX_ADVISORY_BYTES}b")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortkit",
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark (the Spark UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        # remove checkpoint files once their DataFrames are garbage collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def _conf(spark: SparkSession, key: str):
    try:
        return spark.conf.get(key, None)
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given by the cluster and used as is; if it is
    missing there, this raises rather than fall back to a folder on one
    machine.  Only a ``local[...]`` session without the setting (tests) gets
    a scratch folder.
    """
    sc = _context(spark)
    current = (sc.getConf().get("spark.checkpoint.dir", None) if sc else None) \
        or _conf(spark, "spark.checkpoint.dir") or (sc.getCheckpointDir() if sc else None)
    if current:
        if sc and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = (sc.master if sc else _conf(spark, "spark.master")) or ""
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        # a folder on this machine is not shared with the executors
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder all executors share "
                           "(e.g. on HDFS or object storage)")
    # local runs only: nothing names a shared folder, so make a scratch one
    path = tempfile.mkdtemp(prefix="cohortkit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path
