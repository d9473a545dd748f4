import random
import re

import pytest

from cohortkit.llm import decontaminate as D

DOCS = "doc_id long, text string, n_words string"
ITEMS = "item_id long, text string"


def brute(docs, items, window=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    grams = {}
    for key, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(key)
    out = []
    for key, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids |= {str(k) for k in grams[tuple(w[i:i + n])] if k is not None}
        out.append((key, len(w), len(hit), len(ids), sorted(ids)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"])) for r in df.collect()), key=repr)


def random_case(seed, vocabulary=4):
    rng = random.Random(seed)
    text = lambda n: rng.choice(["", " ", "\n"]).join(
        f"{rng.choice(['Ab', 'cd', 'é', 'x9', 'Q'][:vocabulary])}{rng.choice([' ', ', ', '--'])}" for _ in range(n))
    items = [(rng.choice([i, 1, None]), text(rng.choice([1, 2, 3, 9, 10, 11, 25]))) for i in range(12)] + [(50, None), (51, "")]
    docs = [(i // 2, text(rng.choice([0, 1, 5, 40, 120]))) for i in range(30)] + [(None, None), (None, "Ab cd")]
    docs += [(100 + i, f"start {items[i][1] or ''} end") for i in range(12)]
    return docs, items


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block", [250_000, 30])
def test_matches_brute_force(spark, seed, block):
    docs, items = random_case(seed, 2 + seed % 4)
    d = spark.createDataFrame([(k, t, "clash") for k, t in docs], DOCS)
    b = spark.createDataFrame(items, ITEMS)
    found = D.scan(d.select("doc_id", "text"), b, block_words=block).collect()
    got = sorted(((r.doc_id, r['__ck_words'], sum(e - s for s, e in r['__ck_spans']), len(r['__ck_items']), list(r['__ck_items'])) for r in found), key=repr)
    assert got == brute(docs, items)
    if block > 100:
        assert result(D.contamination(d, b)) == brute(docs, items)


def test_items_longer_than_a_block_are_cut_with_overlap(spark):
    rng = random.Random(3)
    words = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(400)]
    items = [(1, " ".join(words)), (1, " ".join(words)), (2, "a b c"), (None, " ".join(words[50:95])), (3, None)]
    docs = [(i, " ".join(["q", *words[i * 7:i * 7 + 7 + i % 9], "q"])) for i in range(56)] + [(100, " ".join(words))]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS).repartition(3)
    sizes = [r.words for r in D.automata(b, block_words=200).select("words").collect()]
    assert len(sizes) > 6 and max(sizes) <= 200
    found = D.scan(d, b, block_words=200).collect()
    got = sorted(((r.doc_id, r['__ck_words'], sum(e - s for s, e in r['__ck_spans']), len(r['__ck_items']), list(r['__ck_items'])) for r in found), key=repr)
    assert got == brute(docs, items)


def test_remove_cuts_passages_and_keeps_clean_rows(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = [(1, f"Before it, {passage} and after.", "a"), (2, "a clean text", "b"), (3, passage, "c"), (4, None, "d"), (2, "a clean text", "b")]
    d = spark.createDataFrame(docs, DOCS)
    b = spark.createDataFrame([(1, passage)], ITEMS)
    out = sorted(tuple(r) for r in D.remove(d, b).collect() if r.text is not None)
    assert out == [(1, "Before it,  and after.", "a"), (2, "a clean text", "b"), (2, "a clean text", "b")]
    assert D.remove(d, b).filter("text IS NULL").count() == 1
    assert D.remove(d, b).columns == d.columns


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "a b c", "x")], DOCS)
    assert D.contamination(d, b).count() == 0
    assert result(D.contamination(one, b)) == [(1, 3, 0, 0, [])]
    assert D.remove(one, b).collect() == one.collect()


def test_long_text():
    item = [f"w{i % 7}" for i in range(30)]
    machine = D.SuffixAutomaton([("a", item)])
    words = [f"w{i % 7}" .encode() for i in range(200_000)]
    machine = D.SuffixAutomaton([("a", [w.encode() for w in item])])
    spans, items = machine.scan(words)
    assert spans == [[0, 200_000]] and items == {"a"}
