"""Helpers shared by the corpus operators.

Columns that operators add to a caller's rows while they work are named
``__ck_...``; these names are reserved, any other column may be there already.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.plans.materialize import write_table

# Rows of one Arrow batch: whole documents of tens of kilobytes have to fit
# into a Python worker several times over.
BATCH_ROWS = 512
BATCH_BYTES = 32 * 1024 * 1024


_HELD: dict[str, object] = {}


def worker_state(owner: str, make):
    """What a Python worker keeps from task to task for one operator (a cache of words).
    Asking for another operator's lets it go, so a worker holds one at a time."""
    if owner not in _HELD:
        _HELD.clear()
        release_memory()
        _HELD[owner] = make()
    return _HELD[owner]


def release_memory() -> None:
    """Give freed memory of this Python worker back to the system: workers live on
    between stages, and the next one's rows need the room."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, under the run's owner.

    Readers start from the files, so a lost executor repeats only the read,
    and every reader sees the same rows.
    """
    return write_table(df, f"llm-{name}")


#: a key with at least this share of all rows is joined by broadcast: at most 1,000 such keys
HOT_SHARE = 1000


def join_skewed(rows: DataFrame, keyed: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with ``keyed``'s columns by ``key`` (inner; ``keyed`` has one row per key, with the
    ``count`` of its rows, which is dropped).

    The keys with a thousandth of all counted rows or more, a thousand at most, are
    broadcast; the others are shuffled, so no task gets more than that of one key.
    """
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    is_hot = F.col(count) * HOT_SHARE >= F.lit(total)
    hot = F.broadcast(keyed.where(is_hot).drop(count))
    cold = keyed.where(~is_hot).drop(count)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


#: rows of a file that are numbered together
SLICE_ROWS = 65_536


def numbered_within(table: DataFrame, group: str, name: str) -> DataFrame:
    """``table`` (as :func:`written` returns it) with ``name``: the place of each row among
    those of its ``group``, gapless from 0.

    Rows are numbered within a slice of a file and offset by the counts of earlier
    slices: the files don't change, so a repeated task finds the same places,
    and a group of any size is spread over its slices.
    """
    at = table.select("*", F.xxhash64("_metadata.file_path").alias("__ck_file"),
                      F.floor(F.col("_metadata.row_index") / SLICE_ROWS).alias("__ck_slice"),
                      F.col("_metadata.row_index").alias("__ck_row"))
    by = [group, "__ck_file", "__ck_slice"]
    before = Window.partitionBy(group).orderBy("__ck_file", "__ck_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = at.groupBy(*by).agg(F.count(F.lit(1)).alias("__ck_n")).select(
        *by, F.coalesce(F.sum("__ck_n").over(before), F.lit(0)).alias("__ck_before"))
    local = at.withColumn("__ck_local", F.row_number().over(Window.partitionBy(*by).orderBy("__ck_row")) - 1)
    return local.join(offsets, by).select(*table.columns, (F.col("__ck_before") + F.col("__ck_local")).alias(name))


def crc_fold(col, folds: int = 5):
    """crc32 of the id written as text, modulo ``folds``; NULL ids count as fold 0."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds, F.lit(0))


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def byte_values(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    return column.to_pylist()


def with_column(df: DataFrame, source: str, name: str, dtype: T.DataType, fn) -> DataFrame:
    """``df`` with one more column, computed batch by batch from ``source``.

    ``fn`` gets a list of byte strings (None for NULL) and returns a list.
    Row order and every other column stay as they are; ``fn`` is called in the
    Python workers.
    """
    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, dtype)])
    out = arrow_schema(schema)
    at = names.index(source)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("rows", dict)
        for batch in batches:
            texts = [None if t is None else (t.encode() if isinstance(t, str) else bytes(t))
                     for t in batch.column(at).to_pylist()]
            made = pa.array(fn(texts), out.field(len(names)).type)
            columns = [c.cast(f.type) if c.type != f.type else c for c, f in zip(batch.columns, out)]
            yield pa.RecordBatch.from_arrays([*columns, made], schema=out)

    return df.mapInArrow(run, schema)
