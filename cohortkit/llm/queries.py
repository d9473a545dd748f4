"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import (
    bottomk,
    decontaminate,
    langid,
    merkle,
    packing,
    render,
    risk,
    sharding,
    suffixdedup,
    surrogates,
    toxicity,
    trie,
    urls,
)
from cohortkit.llm.common import crc_fold, prepare, table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn
    return wrap


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


OP1_SQL = r"""
WITH fold AS (
  SELECT translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, item_id FROM benchmark
), item AS (
  SELECT item_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM fold WHERE t IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, list_slice(w, p, p + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM item WHERE len(w) > 0)
), grams AS (SELECT g, len(g) AS n, list(DISTINCT item_id) AS ids FROM windows GROUP BY g),
sizes AS (SELECT DISTINCT n FROM grams),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), place AS (
  SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM doc, sizes WHERE len(w) >= n
), found AS (
  SELECT place.r, place.p, place.n, grams.ids FROM place JOIN grams ON grams.n = place.n
    AND grams.g = list_slice(place.w, place.p, place.p + place.n - 1)
), hit AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM found) GROUP BY r
), ids AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT r, CAST(unnest(ids) AS VARCHAR) AS i FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""


@_query("op1_decontaminate", OP1_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@_query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    scored = toxicity.score(rows, model)
    return scored.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    found = langid.predict(rows, model)
    return found.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"),
                        F.col("prediction.lang").alias("lang_pred"), F.col("prediction.score").alias("score"))


@_query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


OP6_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingle AS MATERIALIZED (
  SELECT DISTINCT r, list_slice(w, p, p + least(len(w), 5) - 1) AS g
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM doc WHERE len(w) > 0)
), size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
shared AS (
  SELECT a.r AS a, b.r AS b, count(*) AS k FROM shingle a JOIN shingle b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r
), link AS MATERIALIZED (
  SELECT a, b FROM shared JOIN size sa ON sa.r = a JOIN size sb ON sb.r = b WHERE 100 * k >= 75 * (sa.n + sb.n - k)
), reach AS (
  SELECT r, r AS q FROM doc UNION SELECT reach.r, link.b FROM reach JOIN link ON link.a = reach.q
), lowest AS (SELECT reach.r, min(doc.doc_id) AS component_id FROM reach JOIN doc ON doc.r = reach.q GROUP BY reach.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM doc JOIN lowest USING (r) LEFT JOIN size USING (r)
"""


@_query("op6_bottomk_dedup", OP6_SQL)
def op6_bottomk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_shingles", "component_id", "kept")


@_query("op8_risk_quality")
def op8_risk_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = risk.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept")


@_query("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame(list(urls.LABELLED), "url string, label int")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.train(labelled)).select("page_id", "host", "path", "rule", "verdict")


@_query("op2_surrogates")
def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, _ = surrogates.replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", F.col("__ck_replaced").alias("n_replaced"))


@_query("op5_render_html")
def op5_render_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("html"))
    return render.rendered(pages).select("page_id", "text")


OP10_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), pos AS (
  SELECT r, doc_id, p, substr(h, 2 * p + 1, 200) AS g
  FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM doc WHERE length(h) >= 200)
), hashed AS MATERIALIZED (SELECT r, doc_id, p, md5(g) AS g FROM pos),
earliest AS (SELECT g, min(struct_pack(doc_id := doc_id, p := p)) AS f FROM hashed GROUP BY g HAVING count(*) > 1),
late AS (
  SELECT r, p FROM hashed JOIN earliest USING (g) WHERE hashed.doc_id > f.doc_id OR (hashed.doc_id = f.doc_id AND p > f.p)
), edged AS (
  SELECT r, p, max(p) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q FROM late
), span AS (
  SELECT r, min(p) AS a, max(p) + 100 AS b FROM (
    SELECT r, p, sum(CASE WHEN q IS NULL OR p > q + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS s FROM edged
  ) GROUP BY r, s
), gap AS (
  SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM span
), kept AS (
  SELECT gap.r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
    string_agg(substr(doc.h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS h
  FROM gap JOIN doc USING (r) GROUP BY gap.r
)
SELECT doc_id, CAST(length(doc.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(CASE WHEN kept.r IS NULL THEN unhex(doc.h)
    ELSE unhex(kept.h || substr(doc.h, CAST(2 * last + 1 AS BIGINT))) END) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""


@_query("op10_suffix_dedup", OP10_SQL)
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@_query("op11_sharding")
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


_H = "sha256(string_agg(h, '' ORDER BY idx))"
_ENC = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_TAMPERED = ("CASE WHEN crc.c % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') "
             "ELSE text END")


def _leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_ENC.format(c) for c in ("doc_id", "source", "lang", "n_chars", f"({text})")) + ")"


# crc32 of the decimal id, bit by bit: unsigned, reflected polynomial 0xEDB88320
OP12_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id AS id, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    [CAST(ord(x) AS UBIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS UBIGINT) FOR i IN range(8)]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END)) AS r
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
), leaf AS MATERIALIZED (
  SELECT doc_id, source, h, t, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM (SELECT doc_id, source, {_leaf()} AS h, {_leaf(_TAMPERED)} AS t
        FROM documents d LEFT JOIN (SELECT id, xor(r, CAST(4294967295 AS UBIGINT)) AS c FROM crc) crc ON id = doc_id)
), low AS (
  SELECT 0 AS level, tree, idx, h FROM leaf
  UNION ALL
  SELECT any_value(level) + 1, tree, idx // 16, {_H}
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY tree, idx // 16
), depth AS (SELECT tree, max(level) AS top FROM low GROUP BY tree),
subroot AS (SELECT tree, h FROM low JOIN depth USING (tree) WHERE level = top),
high AS (
  SELECT 0 AS level, tree AS idx, h FROM subroot
  UNION ALL
  SELECT any_value(level) + 1, idx // 16, {_H}
  FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY idx // 16
), root AS (SELECT h FROM high WHERE level = (SELECT max(level) FROM high)),
node AS MATERIALIZED (
  SELECT tree, level, idx, h FROM low SEMI JOIN depth ON low.tree = depth.tree AND low.level < depth.top
  UNION ALL SELECT tree, 1000 + level, h2.idx, h2.h FROM (SELECT DISTINCT tree FROM leaf)
    CROSS JOIN (SELECT * FROM high WHERE level < (SELECT max(level) FROM high)) h2
), run AS MATERIALIZED (
  SELECT tree, level, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM node GROUP BY tree, level, idx // 16
), path AS (
  SELECT l.tree, l.idx, 0 AS level, l.idx AS place, t AS folded, '' AS siblings FROM leaf l
  UNION ALL
  SELECT p.tree, p.idx, CASE WHEN run.level IS NULL THEN 1000 ELSE p.level + 1 END,
    CASE WHEN run.level IS NULL THEN p.tree ELSE p.place // 16 END,
    CASE WHEN run.level IS NULL THEN p.folded ELSE
      sha256(array_to_string(list_concat(hs[1:p.place % 16], [p.folded], hs[p.place % 16 + 2:]), '')) END,
    CASE WHEN run.level IS NULL THEN p.siblings ELSE
      p.siblings || array_to_string(list_concat(hs[1:p.place % 16], hs[p.place % 16 + 2:]), '') END
  FROM path p LEFT JOIN run ON run.tree = p.tree AND run.level = p.level AND run.run = p.place // 16
  WHERE run.level IS NOT NULL OR p.level < 1000
), climbed AS (SELECT tree, idx, arg_max(folded, level) AS folded, arg_max(siblings, level) AS siblings FROM path GROUP BY tree, idx)
SELECT doc_id, leaf.h AS leaf, subroot.h AS subroot, root.h AS root, sha256(siblings) AS proof_sha256,
  folded AS folded_root, folded = root.h AS verified
FROM leaf JOIN climbed USING (tree, idx) JOIN subroot USING (tree) CROSS JOIN root
"""


@_query("op12_merkle", OP12_SQL)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.verify(merkle.document_manifest(table(spark, sf_dir, "documents")))
    return found.select(F.col("row_id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                        "verified")


# crc32 of the decimal id as in OP12_SQL
OP13_SQL = r"""
WITH turn AS (
  SELECT conv_id AS c, md5(strlen(role) || ':' || role || text) AS t,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w, turn
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL
), conv AS (
  SELECT c, list(t ORDER BY turn NULLS FIRST, t) AS ts, list(w ORDER BY turn NULLS FIRST, t) AS ws FROM turn GROUP BY c
), crc AS (
  SELECT c, CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    [CAST(ord(x) AS UBIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS UBIGINT) FOR i IN range(8)]),
      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, CAST(3988292384 AS UBIGINT)) ELSE v >> 1 END)),
    CAST(4294967295 AS UBIGINT)) % 4 AS BIGINT) AS h FROM conv
), built AS (
  SELECT conv.c, list_concat(coalesce(b.ts[1:h], []), conv.ts[h + 1:]) AS ts,
    list_concat(coalesce(b.ws[1:h], []), conv.ws[h + 1:]) AS ws
  FROM conv JOIN crc USING (c) LEFT JOIN conv b ON b.c = conv.c - conv.c % 20
), prefix AS MATERIALIZED (
  SELECT c, d, md5(array_to_string(ts[1:d], ',')) AS k, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS w, len(ts) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM built)
), node AS MATERIALIZED (
  SELECT d, k, min(c) AS m, count(*) AS n, max(w) AS w, bool_and(ends) AS leaf,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends
  FROM prefix GROUP BY d, k
), named AS MATERIALIZED (SELECT prefix.c, d, m FROM prefix JOIN node USING (d, k)),
total AS (
  SELECT a.m, a.d, CAST(sum(CAST(leaf AS INT)) AS BIGINT) AS leaves, CAST(sum((n - 1) * w) AS BIGINT) AS saved
  FROM node JOIN named a ON a.c = node.m AND a.d <= node.d GROUP BY a.m, a.d
), parent AS (
  SELECT node.m, node.d, p.m AS parent FROM node LEFT JOIN named p ON p.c = node.m AND p.d = node.d - 1
), child AS (SELECT parent AS m, d - 1 AS d, count(*) AS k FROM parent WHERE d > 0 GROUP BY 1, 2)
SELECT m AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(child.k, 0) AS n_children,
  leaves AS n_leaves, saved AS saved_tokens, ends AS ends_sha256
FROM node JOIN total USING (m, d) JOIN parent USING (m, d) LEFT JOIN child USING (m, d)
"""


@_query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))
