"""Materialising an intermediate frame that several parts of a plan read.

Catalyst prunes columns per consumer, so a frame read by several consumers
is planned, scanned and shuffled once per consumer.  The member profile is
such a frame: it sits on top of the whole purchase history.  Writing it to
the shared folder named by ``spark.checkpoint.dir`` computes it once and cuts
the lineage: a lost executor no longer sends the report back to the history
scan.  The default, ``table``, writes parquet and reads it back: each reader
scans its own columns and filters on read.  ``checkpoint`` is Spark's reliable
``DataFrame.checkpoint``: whole rows, no pruning.  Neither keeps a partitioning;
joins on the member key shuffle both sides.  ``localCheckpoint`` is never used:
it keeps the data on the executors, which may be lost.

Every written table has an owner, a :class:`RunFolder`: inside
``with run_folder(spark):`` the tables of that block, removed when it ends;
elsewhere those of the application, removed when its JVM exits.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from cohortkit.session import ensure_checkpoint_dir

MODES = ("checkpoint", "table", "persist", "none")


@dataclass
class RunFolder:
    """A folder under ``spark.checkpoint.dir`` that owns the tables written in it."""

    spark: SparkSession
    path: str = field(init=False)

    def __post_init__(self) -> None:
        self.path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/cohortkit-run-{uuid.uuid4().hex}"

    def table_path(self, name: str) -> str:
        """A path for a new table, unique within the folder."""
        return f"{self.path}/{name}-{uuid.uuid4().hex}"

    def _hadoop(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def remove(self) -> None:
        """Delete the folder with all its tables; frames that read them can't be used any more."""
        fs, path = self._hadoop()
        fs.delete(path, True)

    def remove_at_exit(self) -> None:
        """Have the file system delete the folder when the driver's JVM exits."""
        fs, path = self._hadoop()
        fs.mkdirs(path)
        fs.deleteOnExit(path)


_ACTIVE: ContextVar[RunFolder | None] = ContextVar("cohortkit_run_folder", default=None)
_OF_APPLICATION: dict[str, RunFolder] = {}


@contextlib.contextmanager
def run_folder(spark: SparkSession) -> Iterator[RunFolder]:
    """Own every table written inside the block and remove them at its end.

    Results that are read later have to be written elsewhere, or collected,
    inside the block.
    """
    folder = RunFolder(spark)
    token = _ACTIVE.set(folder)
    try:
        yield folder
    finally:
        _ACTIVE.reset(token)
        folder.remove()


def owner(spark: SparkSession) -> RunFolder:
    """The folder new tables go to: the enclosing block's, else the application's."""
    active = _ACTIVE.get()
    if active is not None:
        return active
    try:
        application = spark.sparkContext.applicationId
    except Exception:  # Spark Connect: the folder stays until its files are removed from outside
        return _OF_APPLICATION.setdefault("", RunFolder(spark))
    if application not in _OF_APPLICATION:
        folder = RunFolder(spark)
        folder.remove_at_exit()
        _OF_APPLICATION[application] = folder
    return _OF_APPLICATION[application]


def write_table(df: DataFrame, name: str, observed=None) -> DataFrame:
    """``df`` as a parquet table of the current owner (one job); ``observed`` is an
    ``(Observation, *columns)`` tuple to fill while writing."""
    spark = df.sparkSession
    path = owner(spark).table_path(name)
    (df.observe(*observed) if observed else df).write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str, mode: str = "table") -> DataFrame:
    """Return a frame with the same rows whose plan no longer repeats ``df``'s.

    ``checkpoint``: reliable checkpoint into ``spark.checkpoint.dir`` (runs
    the job now).  ``table``: write parquet under ``spark.checkpoint.dir``
    and read it back (runs one job now).  ``persist``: cache in executor
    memory and disk (lazy; lost blocks are recomputed).  ``none``: return
    ``df`` unchanged.
    """
    if mode == "none":
        return df
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode != "table":
        raise ValueError(f"mode must be one of {MODES}")
    return write_table(df, name)


def drop(df: DataFrame) -> None:
    """Remove the files of a frame that :func:`materialize` wrote as a table."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles() if "/cohortkit-run-" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
