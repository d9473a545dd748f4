"""Near-duplicates by bottom-k sketches of one hash function.

1. Every text becomes its set of hashed five-word shingles; the ``K`` smallest
   hashes are its sketch.  Texts with equal sets are one class from here on.
2. Inverted lists hold, for each retained value, the classes that keep it.  A
   class is listed under its rarest retained values only: two sketches that
   share at least ``o`` of their values share one of their ``size - o + 1``
   rarest, so frequent values (common passages) index nothing that rarer ones
   do not.  ``o`` is exact for sets below ``K``; for larger ones it is
   ``MIN_SHARED``, which a linked pair misses with a chance of about 1e-6.
3. A class is compared with the most central classes of its lists; these links
   already join most of a group of copies.  Classes that share a list but stay
   in different components are then joined on their full sets, with exact
   prefix and position tests inside the join.  No list emits all its pairs.
   Of these pairs the closest one of every two components is verified first;
   those whose ends have met by then are decided, all others are verified.
4. Union sketches estimate the similarity of a candidate pair, and the full
   shingle sets decide it: ``100 * |A & B| >= 75 * |A | B|``.
5. Components of the links by alternating star steps.

Defined results: without words or text a document has an empty set and is
linked with nothing; a row with a NULL id is linked with nothing, has a NULL
component and is kept; rows that repeat an id are separate documents.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import join_skewed, worker_state, written
from cohortkit.llm.components import components
from cohortkit.llm.shingles import Shingler, overlap

K = 48
MIN_SHARED = 20
WIDTH = 5
SIMILAR = 75  # percent
HUBS = 4  # classes that each class is compared with before the exact join
CLOSEST = 2  # rounds that verify the closest pair of every two components only
BITMAP = 1024  # bits of a full set's bitmap
EARLIER = 48  # values before its own that a prefix row carries
# the estimate's standard error at the threshold is 0.0625 for K = 48
EST_MARGIN = 0.3


def _shingler(width: int) -> Shingler:
    return worker_state(f"shingles {width}", lambda: Shingler(width))


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Per row: ``doc_id``, ``hash`` of the text, ``n`` (set size), ``digest`` of the set, ``sketch``
    (``k`` smallest hashes, ascending) and ``row`` (a number of its own), as a written table."""
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        shingle, at = _shingler(width), TaskContext.get().partitionId() << 33
        for batch in batches:
            sets = [shingle(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                pa.array(range(at, at + len(sets)), pa.int64())], names=["doc_id", "hash", "n", "digest", "sketch", "row"])
            at += len(sets)

    body = F.col(text).cast("binary")
    made = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    return written(made.mapInArrow(run, f"doc_id {id_type}, hash bigint, n bigint, digest binary, sketch array<bigint>, row bigint"),
                   "sketches")


def classes(rows: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: ``node`` (number), ``doc_id`` (smallest), ``hash`` of
    that row's text, ``n``, ``digest``, ``sketch``."""
    firsts = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("doc_id", "row")).alias("first"))
    nodes = firsts.select(F.col("first.row").alias("row"))
    return written(rows.join(nodes, "row").select(F.col("row").alias("node"), "doc_id", "hash", "n", "digest", "sketch"),
                   "classes")


def _prefix(n, k: int, min_shared: int, similar: int):
    """Length of the rarest-first prefix that a linked class must share a value of."""
    small = math.floor(k * similar / 100)  # a partner of these keeps its whole set
    return F.when(n <= small, n - F.ceil(n * similar / 100) + 1).otherwise(F.least(n, F.lit(k)) - min_shared + 1)


def index(found: DataFrame, k: int = K, min_shared: int = MIN_SHARED, similar: int = SIMILAR) -> DataFrame:
    """Inverted lists: (value, node, n, keys, central) for the values a class is listed
    under; ``central`` is high for a class whose values many others keep."""
    pairs = found.select("node", "n", F.explode("sketch").alias("value"))
    shared = pairs.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    listed = pairs.join(shared, "value").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))  # at most k
    alone = F.least(F.col("n"), F.lit(k)) - F.size("values")
    keys = F.slice("values", F.lit(1), F.greatest(F.lit(0), _prefix(F.col("n"), k, min_shared, similar) - alone).cast("int"))
    listed = listed.select(
        "node", "n", keys.getField("value").alias("keys"),
        F.aggregate("values", F.lit(0).cast("long"), lambda acc, v: acc + v["df"]).alias("central"))
    return written(listed.filter(F.size("keys") > 0), "listed")


def _near_sizes(a, b, similar: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * similar)


def hub_pairs(listed: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """(u, v): every listed class with the ``HUBS`` most central classes that lead its lists."""
    rows = listed.select(F.explode("keys").alias("value"), "node", "n", "central")
    hubs = rows.groupBy("value").agg(F.max(F.struct("central", "node", "n")).alias("hub"), F.count("*").alias("size")) \
        .filter("size > 1").select("value", "hub")
    joined = rows.join(hubs, "value").filter(
        (F.col("node") != F.col("hub.node")) & _near_sizes(F.col("n"), F.col("hub.n"), similar))
    best = joined.groupBy("node").agg(F.sort_array(F.collect_set("hub"), asc=False).alias("hubs"))  # one per key at most
    return best.select(F.col("node").alias("u"), F.explode(F.slice("hubs", 1, HUBS)).alias("hub")) \
        .select("u", F.col("hub.node").alias("v"))


def active(listed: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root) of classes that share a list with a class of another component."""
    rows = listed.join(roots, "node", "left").select(
        F.explode("keys").alias("value"), "node", F.coalesce("root", "node").alias("root"))
    mixed = rows.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")) \
        .filter("lo <> hi").select("value")  # of two classes too: their pair may be cut by HUBS
    return written(rows.join(mixed, "value").select("node", "root").distinct(), "active")


def rest_pairs(sets: DataFrame, tested: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """(u, v, apart, lo, hi): classes of different components ``lo`` and ``hi`` whose full sets
    may be similar enough and that were not compared yet, from rows (node, root, n, values,
    bits); ``apart`` counts the bits that only one of their bitmaps has.

    Full sets are ordered rarest value first.  A linked pair shares a value in
    the smaller set's first ``n - ceil(2t / (1 + t) * n) + 1`` and the larger one's first
    ``n - ceil(t * n) + 1``; after their first common value enough values must be
    left on both sides; and a bit of one set's bitmap that the other's lacks is
    a value outside the intersection.  A pair is made at its first common value
    only: each row carries up to ``EARLIER`` of the values before it, and one that
    both carry has made the pair already.  All tests are exact and stand in the
    join, so a group of texts that differ from each other by more yields few rows.
    """
    single = sets.select("node", F.explode("values").alias("value"))
    shared = single.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = single.join(shared, "value").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("ranked"))  # values of one text
    rows = ranked.join(sets.select("node", "root", "n", "bits"), "node")
    alone = F.col("n") - F.size("ranked")
    probe = F.col("n") - F.ceil(F.col("n") * similar / 100) + 1
    head = F.slice("ranked", F.lit(1), F.greatest(F.lit(0), probe - alone).cast("int"))
    rows = rows.select("node", "root", "n", "bits", alone.alias("alone"), head["value"].alias("head")) \
        .select("node", "root", "n", "bits", "alone", "head", F.posexplode("head").alias("i", "value")) \
        .select("value", "node", "root", "n", "bits", (F.col("alone") + F.col("i") + 1).alias("at"),
                F.slice("head", F.greatest(F.col("i") - (EARLIER - 1), F.lit(1)), F.least(F.col("i"), F.lit(EARLIER)))
                .alias("earlier"))
    rows = written(rows, "prefixes")
    first = F.col("n") - F.ceil(F.col("n") * (2 * similar) / (100 + similar)) + 1
    names = ("node", "root", "n", "at", "bits", "earlier")
    a = rows.filter(F.col("at") <= first).select("value", *[F.col(c).alias(f"a_{c}") for c in names])
    b = rows.select("value", *[F.col(c).alias(f"b_{c}") for c in names])

    def lacking(x: str, y: str):
        """Bits of ``x`` that ``y`` has not."""
        words = [F.bit_count(F.get(x, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(y, F.lit(i))))) for i in range(BITMAP // 64)]
        return reduce(add, words)

    needed = F.ceil((F.col("a_n") + F.col("b_n")) * similar / (100 + similar))
    on = (a["value"] == b["value"]) & (F.struct("a_n", "a_node") < F.struct("b_n", "b_node")) \
        & (F.col("a_root") != F.col("b_root")) & _near_sizes(F.col("a_n"), F.col("b_n"), similar) \
        & (F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at")) + 1 >= needed) \
        & ~F.arrays_overlap("a_earlier", "b_earlier") \
        & (F.col("a_n") - lacking("a_bits", "b_bits") >= needed) & (F.col("b_n") - lacking("b_bits", "a_bits") >= needed)
    apart = lacking("a_bits", "b_bits") + lacking("b_bits", "a_bits")
    pairs = a.join(b, on).select(F.least("a_node", "b_node").alias("u"), F.greatest("a_node", "b_node").alias("v"),
                                 apart.cast("long").alias("apart"), F.least("a_root", "b_root").alias("lo"),
                                 F.greatest("a_root", "b_root").alias("hi")).distinct()
    done = tested.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return pairs.join(done, ["u", "v"], "left_anti")


def estimated(pairs: DataFrame, found: DataFrame, k: int = K, similar: int = SIMILAR) -> DataFrame:
    """The pairs whose union sketch allows the similarity."""
    sides = [found.select(F.col("node").alias(c), F.col("sketch").alias(f"_{c}")) for c in ("u", "v")]
    both = pairs.join(sides[0], "u").join(sides[1], "v")
    union = F.slice(F.array_sort(F.array_union("_u", "_v")), 1, k)
    share = F.size(F.array_intersect(union, F.array_intersect("_u", "_v"))) / F.size(union)
    return both.filter(share >= similar / 100 - EST_MARGIN).select("u", "v")


def texts_of(nodes: DataFrame, found: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, digest, text) of the given nodes, one row each, as a written table.

    A text is found by its id and hash, so other texts that repeat the id don't
    come along; of equal rows one is taken.
    """
    ends = found.select("node", "doc_id", "hash", "digest").join(nodes.select("node").distinct(), "node")
    body = F.col(text).cast("binary")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"))
    return written(texts.join(ends, ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"]).select("node", "digest", "text"),
                   "texts")


def _full_set(shingle: Shingler, body: bytes | None, digest: bytes):
    """The class's set; None for another text whose hash is the same."""
    made = shingle(body)
    return made if xxhash.xxh3_128_digest(made.tobytes()) == digest else None


def _bitmap(values: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP, np.uint8)
    bits[(values >> 7) & (BITMAP - 1)] = 1
    return np.packbits(bits).view(np.int64)


def full_sets(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, n, values, bits) of written texts; ``bits`` is the set's bitmap as longs."""
    def run(batches):
        shingle = _shingler(width)
        for batch in batches:
            sets = {}
            for node, digest, body in zip(*(c.to_pylist() for c in batch.columns)):
                made = _full_set(shingle, body, digest)
                if made is not None:
                    sets[node] = made
            yield pa.RecordBatch.from_arrays([
                pa.array(list(sets), pa.int64()), pa.array([len(s) for s in sets.values()], pa.int64()),
                pa.array(list(sets.values()), pa.list_(pa.int64())),
                pa.array([_bitmap(s) for s in sets.values()], pa.list_(pa.int64()))], names=["node", "n", "values", "bits"])

    return texts.mapInArrow(run, "node bigint, n bigint, values array<bigint>, bits array<bigint>").dropDuplicates(["node"])


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """The pairs (u, v) linked by their full shingle sets."""
    u = texts.select(F.col("node").alias("u"), F.col("digest").alias("u_digest"), F.col("text").alias("u_text"))
    v = texts.select(F.col("node").alias("v"), F.col("digest").alias("v_digest"), F.col("text").alias("v_text"))
    both = pairs.join(u, "u").join(v, "v").select("u", "v", "u_digest", "v_digest", "u_text", "v_text")

    def run(batches):
        shingle, last, held = _shingler(width), None, None
        for batch in batches:
            us, vs, ud, vd, ut, vt = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(us)):
                if last != (vs[i], vt[i]):
                    held, last = _full_set(shingle, vt[i], vd[i]), (vs[i], vt[i])
                own = _full_set(shingle, ut[i], ud[i])
                if own is None or held is None:
                    continue
                both = overlap(own, held)
                if both * 100 >= similar * (len(own) + len(held) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([us[i] for i in keep], pa.int64()),
                                              pa.array([vs[i] for i in keep], pa.int64())], names=["u", "v"])

    return written(both.mapInArrow(run, "u bigint, v bigint"), "links")


def open_pairs(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (u, v, apart, lo, hi) whose ends are still in different components, by the new ``roots``.

    They are joined by their ends, of which no class has many, and not by component.
    """
    for end in ("u", "v"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}")), end, "left") \
            .withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    return written(pairs.filter("_u <> _v").select("u", "v", "apart", F.least("_u", "_v").alias("lo"),
                                                   F.greatest("_u", "_v").alias("hi")), "open-pairs")


def settled(pairs: DataFrame, roots: DataFrame, texts: DataFrame, width: int = WIDTH, similar: int = SIMILAR,
            rounds: int = CLOSEST) -> tuple[DataFrame | None, DataFrame]:
    """Links among the candidate pairs (u, v, apart, lo, hi) and the components they leave, from ``roots``,
    in which ``lo`` and ``hi`` are the components of a pair.

    Each round verifies the least ``apart`` pair of every two components, and pairs
    whose ends have met need no test.  After the rounds every pair that is still
    between two components is verified, so the components are those of all links.
    """
    links = None
    for left in range(rounds, -1, -1):
        closest = F.min(F.struct("apart", "u", "v")).alias("pair")
        asked = written(pairs.groupBy("lo", "hi").agg(closest).select("pair.u", "pair.v"), "closest") if left else pairs
        more = verified(asked.select("u", "v"), texts, width, similar)
        found = bool(more.take(1))
        if found:
            links = more if links is None else links.union(more)
            known = roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
            roots = written(components(known.union(more)), "roots")
        if left:
            pairs = pairs.join(asked, ["u", "v"], "left_anti")
            pairs = open_pairs(pairs, roots) if found else pairs
    return links, roots


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K,
                    width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """One row per input row: ``doc_id``, ``hash`` of its text, ``row``, ``n_shingles``, ``component`` (a
    number; NULL where the set is empty or the id NULL), ``component_id`` (smallest id of the component),
    ``n_links`` (verified links of its class to other classes; pairs already joined through others are
    not verified), and ``kept``."""
    rows = sketches(docs, doc_id, text, k, width)
    found = classes(rows)
    listed = index(found, k, similar=similar)
    tested = written(estimated(hub_pairs(listed, similar), found, k, similar), "hub-pairs")
    ends = tested.select(F.col("u").alias("node")).union(tested.select(F.col("v").alias("node")))
    links = verified(tested, texts_of(ends, found, docs, doc_id, text), width, similar)
    roots = written(components(links), "roots")
    open_ = active(listed, roots)
    texts = texts_of(open_, found, docs, doc_id, text)
    sets = written(full_sets(texts, width).join(open_, "node"), "full-sets")
    more, roots = settled(written(rest_pairs(sets, tested, similar), "rest-pairs"), roots, texts, width, similar)
    links = links if more is None else links.union(more)
    ends = links.select(F.col("u").alias("node")).union(links.select(F.col("v").alias("node")))
    named = found.select("node", "digest", "doc_id").join(roots, "node", "left") \
        .join(ends.groupBy("node").agg(F.count("*").alias("n_links")), "node", "left") \
        .select("digest", "doc_id", "n_links", F.coalesce("root", "node").alias("root"))
    named = written(named, "named")
    least = written(named.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n_classes")), "least")
    labels = join_skewed(named, least, "root", "n_classes").select(
        "digest", "root", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = rows.select("doc_id", "hash", "row", "n", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")) \
        .join(labels, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "hash", "row", F.col("n").alias("n_shingles"), F.col("root").alias("component"),
                      component.alias("component_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: one row of each component stays, the one with the
    smallest id (the first read, if texts of one component repeat the id).

    Rows without an id, without words or without a text are in no component and
    all stay.  Rows are told apart by id and text, as an id may be repeated.
    """
    found = near_duplicates(docs, doc_id, text).filter("component IS NOT NULL")
    chosen = found.groupBy("component").agg(F.min(F.struct("doc_id", "row", "hash")).alias("first")).select(
        F.col("first.doc_id").alias("__ck_id"), F.col("first.hash").alias("__ck_h"))
    member = found.select(F.col("doc_id").alias("__ck_id"), F.col("hash").alias("__ck_h")).distinct()
    chosen, member = written(chosen, "chosen"), written(member, "members")
    rows = docs.withColumns({"__ck_id": F.col(doc_id), "__ck_h": F.xxhash64(F.col(text).cast("binary"))})
    once = Window.partitionBy("__ck_id", "__ck_h").orderBy("__ck_h")
    first = rows.join(chosen, ["__ck_id", "__ck_h"]).withColumn("__ck_n", F.row_number().over(once)).filter("__ck_n = 1")
    alone = rows.join(member, ["__ck_id", "__ck_h"], "left_anti")
    return first.select(*docs.columns).union(alone.select(*docs.columns))
