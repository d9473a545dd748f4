"""Prefix trie of conversations: a node per distinct sequence of first turns.

Subtree totals (leaves, tokens a shared prefix saves) are rolled up by depth
bands of ``BAND`` levels.  Within its band a node's values go to its ancestors
of that band only; a band's roots then hold their part of the band.  The band
roots alone form a trie again, ``BAND`` times shallower, rolled up the same
way; the completed total of a band root goes to its ancestors in the band
above.  A node of depth d costs ``BAND`` rows a round and log_BAND(d) rounds, where
one row per ancestor would cost d and one round per level d.

A turn is a row (conv, depth, digest); its node is the sum of position-tagged
digests up to it, so a conversation of any length is cut into slices of
``SLICE`` turns that are summed apart and offset by the earlier slices.

Defined results: turns are ordered by turn number (NULL first), ties by the
digest of role and text; a NULL role or text is empty; rows without a
conversation id belong to none and give nothing; a conversation without turns
(its id occurs, but all its turns are replaced by none) ends at the root; an
empty table has no node, not even a root.  Columns beyond the named ones are
not read; ``__ck_`` names are not used here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import HOT_SHARE, written

#: levels of a band, turns of a slice, bits of the ids that share a chunk of an id list
BAND, SLICE, CHUNK_BITS = 16, 4096, 12
#: conversations c - c % FAMILY .. of one start share the first turns of the first of them
FAMILY, SHARED = 20, 4
WORDS = r"[^\x20\x09-\x0D]+"


def digest(role: Column, text: Column) -> Column:
    """Identity of a turn: md5 of its role, told apart by its length, and text."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, j, digest, words): turns numbered from 1 in their conversation.

    Sorted over all partitions and written; a turn's number is its place in the
    order less its conversation's.  A conversation that spans partitions is
    joined by (partition, conversation), so no task gets all of a long one.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = written(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")), "trie-turns")
    order = ["conv", "turn", "digest", "salt"]
    placed = written(rows.withColumn("salt", F.col("_metadata.row_index")).repartitionByRange(*order)
                     .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
                     .drop("salt", "turn"), "trie-sorted").withColumn("part", F.shiftright("at", 33))
    spans = placed.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return placed.join(spans, ["conv", "part"]).select(
        "conv", (F.col("at") - F.col("first") + F.col("earlier") + 1).alias("j"), "digest", "words")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, digest, words, length): the turns of every rebuilt conversation, with a root row of
    depth 0 each.

    The first h turns are those of the family's first conversation; what the
    conversation itself has after its first h follows.
    """
    convs = turns.groupBy("conv").agg(F.max("j").alias("n"))
    heads = turns.where((F.col("j") < SHARED) & (F.col("conv") % FAMILY == 0)).groupBy(F.col("conv").alias("start")).agg(
        F.sort_array(F.collect_list(F.struct("j", "digest", "words"))).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).cast("int")
    convs = convs.withColumns({"start": F.col("conv") - F.col("conv") % FAMILY, "h": h}).join(heads, "start", "left") \
        .withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<j:bigint,digest:string,words:bigint>>")),
                                    F.lit(1), F.col("h")))
    convs = written(convs.select("conv", "n", "h", "head", F.size("head").alias("kept"),
                                 (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")),
                    "trie-convs")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"),
                        F.lit(0).cast("long").alias("words"), "length")
    first = convs.select("conv", "length", F.posexplode("head").alias("p", "t")).select(
        "conv", (F.col("p") + 1).cast("long").alias("depth"), "t.digest", "t.words", "length")
    # one row per slice of a conversation, so that a long one is joined slice by slice
    slices = convs.select("conv", "h", "kept", "length",
                          F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / SLICE))).alias("slice"))
    own = turns.withColumn("slice", F.floor(F.col("j") / SLICE)).join(slices, ["conv", "slice"]) \
        .where(F.col("j") > F.col("h")) \
        .select("conv", (F.col("j") - F.col("h") + F.col("kept")).alias("depth"), "digest", "words", "length")
    return root.unionByName(first).unionByName(own)


def prefixed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``node``: the identity of the sequence up to each turn.

    The sum of 128 bits per turn, tagged with its depth, kept as four sums of 32
    bits (they can't overflow below 2^31 turns); written.
    """
    tagged = F.md5(F.concat_ws(":", F.col("depth").cast("string"), F.col("digest")).cast("binary"))
    names = [f"s{i}" for i in range(4)]
    part = [F.conv(F.substring(tagged, 8 * i + 1, 8), 16, 10).cast("long").alias(s) for i, s in enumerate(names)]
    cut = rows.select("*", F.floor(F.col("depth") / SLICE).alias("slice"), *part)
    within = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = written(cut.select("conv", "depth", "words", "length", "slice", *[F.sum(s).over(within).alias(s) for s in names]),
                    "trie-prefixes")
    # only conversations of more than one slice have anything to add
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = local.where((F.col("length") >= SLICE) & ((F.col("depth") % SLICE == SLICE - 1) | (F.col("depth") == F.col("length"))))
    offsets = ends.select("conv", "slice", *[F.sum(s).over(before).alias(f"o{s}") for s in names]).where("slice > 0")
    return local.join(offsets, ["conv", "slice"], "left").select(
        "conv", "depth", "words", "length",
        F.struct("depth", *[(F.col(s) + F.coalesce(F.col(f"o{s}"), F.lit(0))).alias(s) for s in names]).alias("node"))


def _with_node(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows with their node's values: nodes of a thousandth of all rows or more, a thousand at most, are
    broadcast, the others shuffled."""
    total = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    is_hot = F.col("n_convs") * HOT_SHARE >= F.lit(total)
    hot = F.broadcast(nodes.where(is_hot))
    return rows.join(hot, "node").unionByName(
        rows.join(hot.select("node"), "node", "left_anti").join(nodes.where(~is_hot), "node"))


def _rollup(rows: DataFrame, band: int) -> DataFrame:
    """(rep, depth, leaves, saved) subtree totals of the nodes in ``rows`` (conv, depth, rep, leaves, saved;
    the values are the node's own, counted where conv = rep).

    ``rep``, a node's smallest member, and its depth name it; a node's ancestors
    are the nodes of its own representative's earlier turns.
    """
    banded = rows.withColumn("band", F.floor(F.col("depth") / band))
    own = F.col("conv") == F.col("rep")
    # values go to the ancestors within the band: each turn takes what comes at or after it there
    below = Window.partitionBy("conv", "band").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    inside = banded.select("rep", "depth", *[F.sum(F.when(own, F.col(v)).otherwise(F.lit(0))).over(below).alias(v)
                                             for v in ("leaves", "saved")], F.max(own).over(below).alias("some"))
    inside = inside.where("some").groupBy("rep", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    if (rows.agg(F.max("depth")).first()[0] or 0) < band:
        return inside
    inside = written(inside, "trie-band")
    # the band roots are a trie of their own: their values are the totals of their band
    roots = rows.where(F.col("depth") % band == 0).select("conv", (F.col("depth") / band).cast("long").alias("depth"), "rep")
    values = inside.where(F.col("depth") % band == 0).select(
        F.col("rep").alias("conv"), (F.col("depth") / band).cast("long").alias("depth"), "leaves", "saved")
    full = written(_rollup(written(roots.join(values, ["conv", "depth"], "left"), "trie-band-roots"), band), "trie-band-totals")
    # a completed band root goes to its ancestors in the band above it
    carried = full.where("depth > 0").select(F.col("rep").alias("conv"), (F.col("depth") - 1).alias("band"),
                                             F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))
    above = banded.select("conv", "band", "depth", "rep").join(carried, ["conv", "band"]).select(
        "rep", "depth", F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved"))
    return inside.unionByName(above).groupBy("rep", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _hash_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each node's chunks, which come in order and one node after the other; a list is never whole here."""
    held, state = None, None
    for batch in batches:
        done = []
        for rep, depth, ids in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(3).to_pylist()):
            if held != (rep, depth):
                if held is not None:
                    done.append((*held, state.hexdigest()))
                held, state = (rep, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["rep", "depth", "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*held, state.hexdigest())], names=["rep", "depth", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256) of the nodes at which a conversation ends: ids ascending, by chunks of ids."""
    ids = rows.where(F.col("depth") == F.col("length")).groupBy("rep", "depth", F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    schema = T.StructType([T.StructField("rep", T.LongType()), T.StructField("depth", T.LongType()),
                           T.StructField("ends_sha256", T.StringType())])
    return ids.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "chunk").mapInArrow(_hash_lists, schema)


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = prefixed(rebuilt(written(ordered_turns(conversations), "trie-ordered")))
    nodes = written(rows.groupBy("node").agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.count(F.when(F.col("depth") == F.col("length"), F.lit(1))).alias("n_ends")), "trie-nodes")
    placed = written(_with_node(rows.select("conv", "depth", "length", "node"), nodes).select(
        "conv", "depth", "length", "rep", "n_convs",
        (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-placed")
    totals = _rollup(placed.select("conv", "depth", "rep", "leaves", "saved"), band)
    own = placed.where(F.col("conv") == F.col("rep"))
    # the parent: the node of the representative's turn before
    parents = placed.select("conv", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent"))
    linked = written(own.join(parents, ["conv", "depth"], "left").select("conv", "depth", "parent", "n_convs"), "trie-linked")
    children = linked.where("depth > 0").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    ends = written(_ends(placed), "trie-ends")
    none = hashlib.sha256(b"").hexdigest()
    return linked.withColumnRenamed("conv", "rep").join(totals, ["rep", "depth"]).join(children, ["rep", "depth"], "left") \
        .join(ends, ["rep", "depth"], "left").select(
            F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
