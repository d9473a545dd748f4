"""The manifest against a tree built by hand, proofs by walking it."""

import hashlib
import random
import zlib
from collections import Counter

import pytest

from cohortkit.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree long, place long, leaf string"


def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(row, text):
    return _h(_field(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))


def _climb(levels, i, folded, proof):
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16:i // 16 * 16 + 16]
        proof += run[:i % 16] + run[i % 16 + 1:]
        folded, i = _h(run[:i % 16] + [folded] + run[i % 16 + 1:]), i // 16
    return folded


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_h(levels[-1][j:j + 16]) for j in range(0, len(levels[-1]), 16)])
    return levels


def by_hand(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = []
        for r in rows:
            if r["source"] == s:
                hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
                changed = r["text"].translate(lower) if hit and r["text"] is not None else r["text"]
                own.append((r["doc_id"] is not None, r["doc_id"], _leaf(r, r["text"]), _leaf(r, changed)))
        own.sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append((own, _tree([x[2] for x in own])))
    top = _tree([levels[-1][0] for _, levels in trees])
    out = []
    for t, (own, levels) in enumerate(trees):
        for i, (_, doc_id, leaf, changed) in enumerate(own):
            proof = []
            folded = _climb(top, t, _climb(levels, i, changed, proof), proof)
            out.append((doc_id, leaf, levels[-1][0], top[-1][0], _h(proof), folded, folded == top[-1][0]))
    return Counter(out)


def _run(spark, rows):
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], 1, 2, "x") for r in rows], SCHEMA)
    return Counter(tuple(r) for r in merkle.verify(merkle.document_manifest(docs)).collect())


def _row(doc_id, source, text="Some Text", lang="en", n_chars=9):
    return dict(doc_id=doc_id, source=source, text=text, lang=lang, n_chars=n_chars)


def test_a_lone_leaf_is_the_root(spark):
    rows = [_row(7, None, text=None)]
    assert _run(spark, rows) == by_hand(rows)


def test_one_run_and_one_source(spark):
    rows = [_row(i, "a", text=f"Text {i}") for i in range(5)]
    assert _run(spark, rows) == by_hand(rows)


def test_one_source_of_several_levels(spark):
    rows = [_row(i, "a", text=f"Text {i}") for i in range(300)]
    assert _run(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("bits", [16, 5])
def test_many_sources_hot_source_nulls_and_repeats(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "CHUNK_BITS", bits)  # 5: runs near the root are kept for many chunks
    rnd = random.Random(4)
    rows = [_row(i, "hot" if i % 3 else f"s{rnd.randrange(40)}", text=rnd.choice(["Aa", "b", "Ünï", "", None]) and f"T{i} Ä")
            for i in range(900)]
    rows += [_row(i, None, lang=None, n_chars=None) for i in range(900, 920)]
    rows += [_row(None, "hot", text=f"n{i}") for i in range(20)] + [_row(None, None)] * 3
    rows += [_row(5, "hot", text="Same Row")] * 200 + [_row(6, "", text="X" * 200_000)] + [_row(6, "é", text="E")]
    assert _run(spark, rows) == by_hand(rows)


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    manifest = merkle.document_manifest(docs)
    found = merkle.verify(manifest)
    assert manifest.root is None and found.collect() == []
    assert found.columns == ["row_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_a_change_of_one_byte_is_found(spark):
    rows = [_row(i, f"s{i % 3}", text=f"text {i}") for i in range(100)]  # nothing to lower-case
    assert all(r[-1] for r in _run(spark, rows))
    rows[35]["text"] = "Text 35"  # crc32("35") % 5 decides whether its copy was changed
    hit = zlib.crc32(b"35") % 5 == 0
    assert [r[0] for r in _run(spark, rows) if not r[-1]] == ([35] if hit else [])
