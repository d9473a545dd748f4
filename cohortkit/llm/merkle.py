"""Merkle manifest of a dataset: a tree per group, a tree over the groups' roots,
and proofs checked by a recursive query.

Every row is a leaf: the hash of its fields.  Leaves of a group are ordered;
every ``FANOUT`` consecutive nodes become their hash until one is left; the
groups' roots, in order of the group, are the leaves of the tree on top.  The
built levels are kept as node rows (*runs*): a run holds its children's digests
and the link to its own place in the run above (``up_tree``, ``up_level``,
``up_place``).

``verify`` climbs with one ``WITH RECURSIVE`` query.  The leaves of one run have
the same siblings on every level above it, so they climb in one row: an array
with each leaf's folded hash and one binary with the siblings met so far.  All
rows meet the same few runs near the root; a run is therefore kept once per
chunk of 2^``CHUNK_BITS`` leaves under it, and no key of the climb's join has
more rows than a chunk has runs.

Digests are kept as 32 bytes and hashed as hex text.

Defined results: a NULL field is hashed as ``-``; rows of a group are ordered by
the order column (NULL first), ties by their leaf hash, equal rows one after
the other; groups are ordered NULL first, then by their UTF-8 bytes; a lone
leaf is its group's root, a lone group's root is the root; an empty table gives
no rows and a NULL root.  Columns beyond the named ones are not read; names
with ``__ck_`` are not used here.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
CHUNK_BITS = 16
TOP = -1  # the tree over the groups' roots


def field_bytes(value: Column) -> Column:
    """A field as hashed: ``-`` for NULL, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hex_text(data: Column) -> Column:
    return F.lower(F.hex(data))


def leaf_digest(changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS) -> Column:
    return digest(F.concat(*[field_bytes((changed or {}).get(f, F.col(f))) for f in fields]))


@dataclass
class Manifest:
    """The written tables of one dataset's trees."""

    leaf_runs: DataFrame  # tree, n, run, low, lone, only, members (array of row_id, leaf, altered, in order)
    runs: DataFrame       # tree, level, run, chunk, children, up_tree, up_level, up_place
    root: str | None


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` sorted over all partitions and written, ``at`` its position (``part`` the partition).

    Each partition's size is at hand after the write, one row per partition.
    """
    part = F.shiftright(F.col("at"), 33)
    table = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()), "merkle-sorted").withColumn("part", part)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return table.join(F.broadcast(starts), "part").withColumn(
        "at", F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("start")


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (grp, key, row_id, leaf, altered) as (tree, n, place, at, row_id, leaf, altered), ``n`` the
    tree's leaves, and the trees (tree, n), numbered in order of the group.

    A group's rows are neighbours in the order, so what a row needs of its
    group is joined by (partition, group): a large group is in many partitions.
    """
    salted = rows.withColumn("salt", F.col("_metadata.row_index"))  # equal rows can be parted too
    ordered = _numbered(salted, "grp", "key", "leaf", "salt").drop("salt")
    spans = written(ordered.groupBy("part", "grp").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")),
                    "merkle-spans")
    groups = _numbered(spans.groupBy("grp").agg(F.min("first").alias("first"), F.sum("n").alias("n")), "first") \
        .select("grp", F.col("at").alias("tree"), "first", "n")
    groups = written(groups, "merkle-groups")
    of_span = spans.select("part", "grp").alias("s").join(
        groups.alias("g"), F.col("s.grp").eqNullSafe(F.col("g.grp"))).select("s.part", "s.grp", "tree", "g.first", "g.n")
    rows = ordered.alias("r").join(of_span.alias("s"), (F.col("r.part") == F.col("s.part"))
                                   & F.col("r.grp").eqNullSafe(F.col("s.grp")))
    return rows.select("tree", "n", (F.col("at") - F.col("first")).alias("place"), "at", "row_id", "leaf", "altered"), \
        groups


def _joined(column: str) -> Column:
    """Digests of an array of structs, one after the other."""
    return F.aggregate(F.transform(column, lambda m: m["leaf"]), F.unhex(F.lit("")), lambda a, x: F.concat(a, x))


def _levels(nodes: DataFrame, level: int, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Runs of every level above ``nodes`` (tree, n, place, low, high, hash; ``n`` the tree's
    nodes of this level, ``most`` at most) and each tree's last node (tree, low, high, hash).

    A tree of n nodes has ceil(n / FANOUT) on the next level, and is done at one.
    """
    runs, done, counted = [], [], nodes
    while most > 1:
        done.append(counted.where(F.col("n") == 1).select("tree", "low", "high", "hash"))
        up = counted.where(F.col("n") > 1).withColumn("run", F.floor(F.col("place") / FANOUT))
        grouped = up.groupBy("tree", "run").agg(
            F.sort_array(F.collect_list(F.struct("place", F.col("hash").alias("leaf")))).alias("members"),
            F.min("low").alias("low"), F.max("high").alias("high"), F.first("n").alias("n"))
        table = written(grouped.select("tree", F.lit(level).alias("level"), "run", "low", "high", "n",
                                       _joined("members").alias("children")), f"merkle-{name}")
        runs.append(table)
        counted = table.select("tree", F.col("run").alias("place"), "low", "high",
                               digest(hex_text(F.col("children"))).alias("hash"),
                               F.ceil(F.col("n") / FANOUT).alias("n"))
        most, level = -(-most // FANOUT), level + 1
    done.append(counted.select("tree", "low", "high", "hash"))
    return runs, reduce(DataFrame.unionByName, done)


def build(rows: DataFrame, group: Column, order: Column, row_id: Column, leaf: Column, altered: Column) -> Manifest:
    """The manifest of ``rows``; ``altered`` is the leaf digest a proof is checked with
    (equal to ``leaf`` where nothing changed)."""
    narrow = written(rows.select(group.alias("grp"), order.alias("key"), row_id.alias("row_id"),
                                 leaf.alias("leaf"), altered.alias("altered")), "merkle-leaves")
    placed, sizes = _placed(narrow)
    leaf_runs = placed.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("place", "at", "row_id", "leaf", "altered"))).alias("members"),
        F.min("at").alias("low"), F.first("n").alias("n"))
    most, trees = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    leaf_runs = written(leaf_runs.withColumns({"lone": F.col("n") == 1, "only": F.lit(trees == 1)}), "merkle-leaf-runs")
    if not trees:
        return Manifest(leaf_runs, None, None)
    # level 0 is in leaf_runs; its runs' hashes are level 1, a lone leaf is its tree's last node
    nodes = leaf_runs.select(
        "tree", F.ceil(F.col("n") / FANOUT).alias("n"), F.col("run").alias("place"), "low", F.col("low").alias("high"),
        F.when(F.col("lone"), F.col("members")[0]["leaf"]).otherwise(digest(hex_text(_joined("members")))).alias("hash"))
    runs, roots = _levels(nodes, 1, -(-most // FANOUT), "levels")
    roots = written(roots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(trees).cast("long").alias("n"),
                                 F.col("tree").alias("place"), "low", "high", "hash"), "merkle-roots")
    top_runs, top = _levels(roots, 0, trees, "top")
    root = top.first()["hash"]
    above = None if trees == 1 else TOP  # a lone group's root has nothing above it

    def linked(table: DataFrame, beyond: int | None) -> DataFrame:
        more = F.col("n") > FANOUT
        return table.select(
            "tree", "level", "run", "children",
            F.when(more, F.col("tree")).otherwise(F.lit(beyond).cast("long")).alias("up_tree"),
            F.when(more, F.col("level") + 1).otherwise(F.lit(0)).alias("up_level"),
            F.when(more, F.col("run")).otherwise(F.col("tree")).alias("up_place"),
            F.explode(F.sequence(F.shiftright("low", CHUNK_BITS), F.shiftright("high", CHUNK_BITS))).alias("chunk"))

    every = [linked(t, above) for t in runs] + [linked(t, None) for t in top_runs]
    kept = written(reduce(DataFrame.unionByName, every), "merkle-runs") if every else None
    return Manifest(leaf_runs, kept, bytes(root).hex())


# One step: the row's place within the run above it, its siblings left and right of it.
CLIMB = f"""
WITH RECURSIVE climb (tree0, run0, chunk, tree, level, place, folded, subroot, siblings) AS (
  SELECT tree0, run0, chunk, tree, level, place, folded, subroot, siblings FROM {{base}}
  UNION ALL
  SELECT c.tree0, c.run0, c.chunk, r.up_tree, r.up_level, r.up_place,
         transform(c.folded, f -> unhex(sha2(lower(hex(concat(
           substring(r.children, 1, CAST(32 * (c.place % {FANOUT}) AS INT)), f,
           substring(r.children, CAST(32 * (c.place % {FANOUT}) + 33 AS INT))))), 256))),
         CASE WHEN c.tree <> {TOP} AND coalesce(r.up_tree, {TOP}) = {TOP}
              THEN unhex(sha2(lower(hex(r.children)), 256)) ELSE c.subroot END,
         concat(c.siblings, substring(r.children, 1, CAST(32 * (c.place % {FANOUT}) AS INT)),
                substring(r.children, CAST(32 * (c.place % {FANOUT}) + 33 AS INT)))
  FROM climb c JOIN {{runs}} r
    ON r.tree = c.tree AND r.level = c.level AND r.run = c.place DIV {FANOUT} AND r.chunk = c.chunk
)
SELECT tree0, run0, folded, subroot, siblings FROM climb WHERE tree IS NULL
"""


def verify(manifest: Manifest) -> DataFrame:
    """row_id, leaf, subroot, root, proof (hash of the siblings), folded_root and verified of every leaf."""
    members = manifest.leaf_runs
    if manifest.root is None:
        empty = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        kept = members.select(F.explode("members").alias("m")).select("m.row_id")
        return kept.select("row_id", *[F.lit(None).cast(f.split(" ")[1]).alias(f.split(" ")[0]) for f in empty.split(", ")])
    spark = members.sparkSession
    digests, none = _joined("members"), F.unhex(F.lit(""))
    others = lambda i: F.concat(F.substring(digests, F.lit(1), (i * 32).cast("int")),
                                F.substring(digests, (i * 32 + 33).cast("int"), F.lit(32 * FANOUT)))
    fold = lambda m, i: F.when(F.col("lone"), m["altered"]).otherwise(digest(hex_text(F.concat(
        F.substring(digests, F.lit(1), (i * 32).cast("int")), m["altered"],
        F.substring(digests, (i * 32 + 33).cast("int"), F.lit(32 * FANOUT))))))
    ends = F.col("n") <= FANOUT  # the run's hash is its tree's root
    above = F.when(F.col("only"), F.lit(None)).otherwise(F.lit(TOP)).cast("long")
    base = members.select(
        F.col("tree").alias("tree0"), F.col("run").alias("run0"), F.shiftright("low", CHUNK_BITS).alias("chunk"),
        F.when(ends, above).otherwise(F.col("tree")).alias("tree"),
        F.when(ends, F.lit(0)).otherwise(F.lit(1)).alias("level"),
        F.when(ends, F.col("tree")).otherwise(F.col("run")).alias("place"),
        F.transform("members", fold).alias("folded"),
        F.when(F.col("lone"), F.col("members")[0]["leaf"]).when(ends, digest(hex_text(digests))).alias("subroot"),
        none.alias("siblings"))
    base = written(base, "merkle-base")
    if manifest.runs is None:
        climbed = base.select("tree0", "run0", "folded", "subroot", "siblings")
    else:
        # rows that climb as many rounds as there are levels; a session's default stops at a million rows
        limit = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
        spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
        try:
            climbed = written(spark.sql(CLIMB, base=base, runs=manifest.runs), "merkle-climbed")
        finally:
            if limit is None:
                spark.conf.unset("spark.sql.cteRecursionRowLimit")
            else:
                spark.conf.set("spark.sql.cteRecursionRowLimit", limit)
    met = members.join(climbed, (members.tree == climbed.tree0) & (members.run == climbed.run0))
    own = F.transform("members", lambda m, i: F.struct(
        m["row_id"].alias("row_id"), m["leaf"].alias("leaf"),
        F.when(F.col("lone"), none).otherwise(others(i)).alias("siblings"), F.get("folded", i).alias("folded")))
    one = met.select("subroot", F.col("siblings").alias("above"), F.explode(own).alias("m"))
    root = F.lit(manifest.root)
    return one.select(
        F.col("m.row_id").alias("row_id"), hex_text(F.col("m.leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(hex_text(F.concat("m.siblings", "above")).cast("binary"), 256).alias("proof_sha256"),
        hex_text(F.col("m.folded")).alias("folded_root"), (hex_text(F.col("m.folded")) == root).alias("verified"))


def tampered_text(text: Column, doc_id: Column) -> Column:
    """The text a copy of the dataset came back with: A-Z lower-cased in every fifth row by the id's crc32."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate(text, upper, upper.lower())).otherwise(text)


def document_manifest(docs: DataFrame) -> Manifest:
    """Documents by source, proofs checked against the tampered texts."""
    return build(docs, F.col("source"), F.col("doc_id"), F.col("doc_id"), leaf_digest(),
                 leaf_digest({"text": tampered_text(F.col("text"), F.col("doc_id"))}))
