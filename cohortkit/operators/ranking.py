"""Row number within a group that stays parallel when one group is huge.

``row_number() OVER (PARTITION BY key ORDER BY ...)`` sends every row of a
key to one task.  When one member holds a large share of all rows that task
does most of the work.  Here each group is cut into slices by ``buckets`` that
never decrease along the order (e.g. the hour of the paid time, then the
second within it): rows are numbered within a slice, spread over all tasks,
and a small table of slice counts supplies the offset of every slice.
The slicing is a pure function of the row, so a recomputed task (lost
executor) puts every row in the same slice again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__bucket"
_LOCAL = "__local_rn"
_COUNT = "__bucket_rows"
_OFFSET = "__bucket_offset"


def row_number_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], buckets: Sequence[Column],
                      name: str = "rk") -> DataFrame:
    """Add ``name`` = 1-based position of each row within its ``keys`` group.

    ``order`` must make the order total within a group (no ties), otherwise
    positions of tied rows are arbitrary, as with ``row_number``.  ``buckets``
    are levels of slices, coarse to fine: non-NULL, and not decreasing along
    ``order`` within the level above.  Sizes of the finest slices are counted
    before anything is numbered; each level adds its own offset within the
    level above, so neither a slice nor an offset window grows with the group.
    A NULL key forms its own group, as in ``PARTITION BY``; keys are compared
    through their string form (meant for string and integer keys).
    """
    # Each key travels as two non-null columns (is-null flag, string value),
    # so grouping is NULL-safe while the join at the end is a plain equi-join
    # on columns the numbered rows are already partitioned by.
    group, enc = [], []
    for i, k in enumerate(keys):
        enc += [F.col(k).isNull().alias(f"__kn{i}"),
                F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"__kv{i}")]
        group += [f"__kn{i}", f"__kv{i}"]
    levels = [f"{_BUCKET}{i}" for i in range(len(buckets))]
    keyed = df.select("*", *enc, *[b.alias(c) for b, c in zip(buckets, levels)])
    sizes = keyed.groupBy(*group, *levels).agg(F.count(F.lit(1)).alias(_COUNT))
    offsets = sizes
    for i in reversed(range(len(levels))):
        # rows of the same parent slice in earlier slices of this level
        parent = [*group, *levels[:i]]
        before = Window.partitionBy(*parent).orderBy(levels[i]).rowsBetween(Window.unboundedPreceding, -1)
        finest = i == len(levels) - 1
        level = sizes if finest else sizes.groupBy(*parent, levels[i]).agg(F.sum(_COUNT).alias(_COUNT))
        level = level.select(*parent, *levels[i:i + 1],
                             F.coalesce(F.sum(_COUNT).over(before), F.lit(0)).alias(f"{_OFFSET}{i}"))
        offsets = level if finest else offsets.join(level, [*parent, levels[i]])
    total = F.col(f"{_OFFSET}0")
    for i in range(1, len(levels)):
        total = total + F.col(f"{_OFFSET}{i}")
    offsets = offsets.select(*group, *levels, total.alias(_OFFSET))
    local = keyed.withColumn(_LOCAL, F.row_number().over(Window.partitionBy(*group, *levels).orderBy(*order)))
    joined = local.join(offsets, on=[*group, *levels], how="inner")
    return joined.select(*df.columns, (F.col(_OFFSET) + F.col(_LOCAL)).cast("int").alias(name))
