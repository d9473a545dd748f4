"""Shards of nearly equal bytes by Karmarkar-Karp differencing of indivisible groups.

Rows with equal texts form a group that stays together.  Differencing keeps
partial partitions (the sums of ``k`` lanes); again and again the two with the
largest spread are combined, the fullest lanes of one on the emptiest of
the other, until one is left.

Groups are not brought to one place: while there are more than ``LAST`` of them
they are dealt by hash into blocks of some ``BLOCK``, and each block is
differenced into fewer bundles (a tenth, at first), which are the next round's items.
What is large against a lane of the last round, and some groups dealt by hash
that can level off what is left, go there as they are.  The last round has a
bounded number of items, whatever the data.

Defined results: a NULL text counts as an empty one (both 16 bytes and one
group); a NULL or repeated id is a row like any other; a group above a fair
share gets a shard of its own and the others share the rest evenly; shards
without a group stay empty; an empty table gives no rows.  Columns named
``__ck_...`` are reserved, all others pass through ``carry``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import join_skewed, numbered_within, written

SHARDS = 40
#: bytes a row counts beside its text
ROW_BYTES = 16
#: groups of one block, groups of one bundle at most, items of the last round
BLOCK, FAN_IN, LAST = 20_000, 10, 50_000
#: groups that stay single till the last round, dealt by hash
SINGLES = 20_000


def difference(sizes: np.ndarray, lanes: int) -> np.ndarray:
    """Lane of each item, lane 0 the fullest: Karmarkar-Karp over ``lanes`` lanes.

    A partial partition is held as its lanes that are not empty, fullest
    first, each named by one of its items; lanes put on each other are linked
    (``up``), so an item's lane is found at the end.
    """
    sizes = np.asarray(sizes, dtype=np.int64)
    n = len(sizes)
    if n == 0 or lanes == 1:
        return np.zeros(n, dtype=np.int64)
    up = np.arange(n)
    parts = {i: (sizes[i:i + 1], up[i:i + 1].copy()) for i in range(n)}
    order = np.argsort(-sizes, kind="stable")
    heap = [(-int(sizes[i]), rank, int(i)) for rank, i in enumerate(order)]  # sorted, so a heap
    rank = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        (xs, xl), (ys, yl) = parts.pop(a), parts.pop(b)
        free_x, free_y = max(lanes - len(ys), 0), max(lanes - len(xs), 0)  # lanes that meet an empty one
        if free_x < len(xs):
            over, under = slice(free_x, len(xs)), yl[free_y:][::-1]
            up[under] = xl[over]
            sums = np.concatenate([xs[:free_x], ys[:free_y], xs[over] + ys[free_y:][::-1]])
            names = np.concatenate([xl[:free_x], yl[:free_y], xl[over]])
        else:
            sums, names = np.concatenate([xs, ys]), np.concatenate([xl, yl])
        by = np.argsort(-sums, kind="stable")
        sums, names = sums[by], names[by]
        parts[a] = (sums, names)
        spread = int(sums[0] - (sums[-1] if len(sums) == lanes else 0))
        heapq.heappush(heap, (-spread, rank, a))
        rank += 1
    (sums, names), = parts.values()
    while True:  # follow the links, doubling the step
        further = up[up]
        if np.array_equal(further, up):
            break
        up = further
    lane = np.zeros(n, dtype=np.int64)
    lane[names] = np.arange(len(names))
    return lane[up]


def partition(sizes: np.ndarray, lanes: int) -> np.ndarray:
    """:func:`difference` for a last round: an item of at least the fair share of what
    is left takes a lane alone, the others are differenced over the other lanes."""
    sizes = np.asarray(sizes, dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(len(sizes), dtype=np.int64)
    alone, left = 0, int(sizes.sum())
    while alone < min(lanes - 1, len(sizes)) and sizes[order[alone]] * (lanes - alone) >= left > 0:
        out[order[alone]] = alone
        left -= int(sizes[order[alone]])
        alone += 1
    rest = order[alone:]
    out[rest] = alone + difference(sizes[rest], lanes - alone)
    return out


def _bundled(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["size", "item"], ascending=[False, True])
    lanes = -(-len(block) // int(block["fan_in"].iloc[0]))
    lane = difference(block["size"].to_numpy(), lanes)
    return pd.DataFrame({"item": block["item"], "size": block["size"],
                         "bundle": block["block"].to_numpy() * (4 * BLOCK) + lane})


def place(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(item, shard) for ``groups`` (item long, unique; size long)."""
    total, count = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    large = F.col("size") * LAST >= F.lit(max(int(total), 1)).cast("decimal(38,0)")  # LAST of them at most
    staying, dealt = [], []
    items, level = groups, 0
    while count > LAST:
        stays = large
        if level == 0:
            stays = stays | (F.pmod(F.xxhash64("item", F.lit("single")), F.lit(count)) < SINGLES)
        staying.append(items.where(stays).withColumn("level", F.lit(level)))
        blocks = -(-count // BLOCK)
        fan_in = min(FAN_IN, -(-2 * count // LAST))  # not far fewer than the last round may have
        pool = items.where(~stays).select("item", "size", F.lit(fan_in).alias("fan_in"),
                                          F.pmod(F.xxhash64("item", F.lit(level)), F.lit(blocks)).alias("block"))
        bundled = written(pool.groupBy("block").applyInPandas(_bundled, "item long, size long, bundle long"),
                          "bundles")
        dealt.append(bundled)
        items = written(bundled.groupBy(F.col("bundle").alias("item")).agg(F.sum("size").alias("size")), "items")
        count, level = items.count(), level + 1
    last = items.withColumn("level", F.lit(level))
    for stay in staying:
        last = last.unionByName(stay)

    def assign(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "level", "item"], ascending=[False, True, True])
        return pd.DataFrame({"level": rows["level"], "item": rows["item"],
                             "shard": partition(rows["size"].to_numpy(), shards)})

    placed = written(last.groupBy().applyInPandas(assign, "level int, item long, shard int"), "placed")
    found = placed.where(F.col("level") == level).select("item", "shard")
    for lower in reversed(range(level)):  # from bundles down to what they are made of
        inside = dealt[lower].select("item", "bundle").join(
            found.withColumnRenamed("item", "bundle"), "bundle").select("item", "shard")
        found = inside.unionByName(placed.where(F.col("level") == lower).select("item", "shard"))
    return found


def assign(docs: DataFrame, shards: int = SHARDS, carry: tuple[str, ...] = ("doc_id",),
           text: str = "text") -> DataFrame:
    """``carry``, size, text_crc32, shard and slot (the row's place in its shard) of every row."""
    kept = F.coalesce(F.col(text), F.lit(""))
    rows = written(docs.select(
        *carry,
        (F.octet_length(kept) + F.lit(ROW_BYTES)).cast("long").alias("__ck_size"),
        F.crc32(kept.cast("binary")).alias("__ck_crc"),
        F.xxhash64(kept).alias("__ck_key")), "shard-rows")  # texts with one hash stay together: harmless
    groups = written(rows.groupBy("__ck_key").agg(F.sum("__ck_size").alias("size"), F.count(F.lit(1)).alias("n"))
                     .withColumnRenamed("__ck_key", "item"), "shard-groups")
    placed = place(groups.select("item", "size"), shards)
    keyed = placed.join(groups.select("item", "n"), "item").withColumnRenamed("item", "__ck_key")
    joined = written(join_skewed(rows, keyed, "__ck_key", "n"), "shard-placed")
    numbered = numbered_within(joined, "shard", "__ck_slot")
    return numbered.select(*carry, F.col("__ck_size").alias("size"), F.col("__ck_crc").alias("text_crc32"),
                           F.col("shard"), F.col("__ck_slot").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> None:
    """Whole rows of ``docs`` as Parquet under ``path``, one folder ``__ck_shard=<number>`` per shard."""
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    keyed = docs.withColumn("__ck_key", key)
    sizes = F.octet_length(F.coalesce(F.col(text), F.lit(""))) + F.lit(ROW_BYTES)
    groups = written(keyed.groupBy(F.col("__ck_key").alias("item")).agg(
        F.sum(sizes).cast("long").alias("size"), F.count(F.lit(1)).alias("n")), "shard-groups")
    placed = place(groups.select("item", "size"), shards).join(groups.select("item", "n"), "item")
    rows = join_skewed(keyed, placed.select(F.col("item").alias("__ck_key"), "n", F.col("shard").alias("__ck_shard")),
                       "__ck_key", "n")
    rows.drop("__ck_key").write.partitionBy("__ck_shard").parquet(path)
