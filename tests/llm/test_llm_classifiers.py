import random

import numpy as np
import pytest

from cohortkit.llm import langid, toxicity

BAD = ("idiot", "scum", "moron")


def toxic_rows(n, seed=1):
    rng = random.Random(seed)
    syllables = ["an", "er", "the", "on", "ing", "re", "ti", "ha"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.choice([5, 60, 200]))]
        y = int(rng.random() < 0.2)
        if y:
            for _ in range(3):
                words.insert(rng.randrange(len(words) + 1), rng.choice(BAD))
        rows.append((i, " ".join(words), y))
    return rows


def test_toxicity_held_out_accuracy(spark):
    rows = toxic_rows(900)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3] + [(5, None), (None, 1), (7, 9)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r._s for r in toxicity.score(docs, model, name="_s").collect()}
    unseen = [(i, y) for i, _, y in rows if not i % 3]
    assert np.mean([(got[i] >= 0.5) == y for i, y in unseen]) > 0.97
    assert all(0 <= s <= 1 for s in got.values())


@pytest.mark.parametrize("n,markers", [(70, 1), (1500, 20)])
def test_toxicity_markers_that_no_clean_text_has(n, markers):
    rng = random.Random(8)
    plain = [t for _, t, y in toxic_rows(2 * n) if not y]
    bad = ["".join(rng.choices("bcdfgjkmpquvwxyz", k=6)) for _ in range(markers)]
    rows = [(f"{t} {bad[i % markers]} {plain[i]}" if i % 6 == 0 else t, int(i % 6 == 0)) for i, t in enumerate(plain[:n])]
    model = toxicity.fit([t.encode() for t, _ in rows], [y for _, y in rows])
    unseen = [f"{t} {bad[6 * i % markers]}" for i, t in enumerate(plain[n:n + 60])]
    assert np.mean(np.array(model.scores([t.encode() for t in unseen])) >= 0.5) > 0.9
    assert np.mean(np.array(model.scores([t.encode() for t in plain[n:n + 60]])) >= 0.5) < 0.1


@pytest.mark.parametrize("sf,least", [("sf0.001", 1.0), ("sf0.01", 0.6)])
def test_toxicity_held_out_recall_on_given_tables(spark, sf, least):
    from cohortkit.llm.common import crc_fold, table
    docs, labels = (table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = docs.join(labels.filter(crc_fold(labels["doc_id"]) == 0).select("doc_id", "toxic"), "doc_id")
    got = [(r._s >= 0.5, r.toxic) for r in toxicity.score(held, model, name="_s").select("_s", "toxic").collect()]
    assert np.mean([p for p, y in got if y]) >= least and not any(p for p, y in got if y == 0)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (None, "a " * 50_000, "x"), (2, "ok", "x"), (2, "ok", "x")],
                                 "doc_id long, text string, predicted string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, none), name="s").collect()
    assert len(scored) == 5 and all(r.s < 1e-6 for r in scored)
    only = spark.createDataFrame([(2, 1), (2, 1)], "doc_id long, toxic int")
    assert all(r.s > 0.5 for r in toxicity.score(docs, toxicity.train(docs, only), name="s").collect())
    assert toxicity.score(docs.limit(0), toxicity.train(docs, only), name="s").count() == 0
    assert toxicity.train(docs.limit(0), only).index.size == 0


def test_toxicity_same_fit_for_any_order():
    rows = toxic_rows(200)
    texts, ys = [t.encode() for _, t, _ in rows], [y for _, _, y in rows]
    a, b = toxicity.fit(texts, ys, 0.2), toxicity.fit(texts, ys, 0.2)
    assert a.scores(texts) == b.scores(texts)


def language_rows(n, seed=3):
    rng = random.Random(seed)
    parts = {"en": "the ing er and of", "fr": "eau oi le é ment", "de": "ung ch ü der keit", "es": "ción ñ ado el que"}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        rows.append((i, " ".join("".join(rng.choices(parts[lang].split(), k=2)) for _ in range(rng.choice([3, 40, 300]))), lang))
    return rows


def test_language_held_out_accuracy(spark):
    rows = language_rows(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, per_language=60, landmarks=40)
    got = {r.doc_id: r.prediction for r in langid.predict(docs, model).collect()}
    assert np.mean([got[i].lang == lang for i, _, lang in rows]) > 0.97
    assert all(0 <= p.score <= 1 for p in got.values())


def test_language_edges(spark):
    rows = language_rows(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, per_language=40, landmarks=20)
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "123 !? ²"), (4, "the " * 30_000)], "doc_id long, text string")
    got = [(r.prediction.lang, r.prediction.score) for r in langid.predict(odd, model).collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3][0] == "en"
    unlabelled = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert langid.predict(unlabelled, langid.train(unlabelled)).collect()[0].prediction.lang == "und"
    assert langid.predict(docs.limit(0), model).count() == 0


def test_kernel_is_the_share_of_common_grams():
    x = langid.presence([b"abab", b"abc", b""], orders=(1, 2), bits=14)
    # a, b, ab, ba against a, b, c, ab, bc
    assert float(x[0] @ x[1]) == pytest.approx(3 / np.sqrt(4 * 5), abs=1e-6)
    assert float(x[2].sum()) == 0
