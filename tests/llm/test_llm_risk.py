import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cohortkit.llm import risk

SCHEMA = "doc_id long, text string, lang string, n_words string"
LABELS = "doc_id long, quality int"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + d for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for d in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def cases():
    rng = random.Random(1)
    word = lambda: rng.choice(["a", "bé", "c#", "|", "dd", "e<"])
    texts = [None, "", " \n\t ", "a b", "a b a b a b", "a  b\n\na  b\n \nx\x0by", "x " * 5000, "é𝄞 z\r\nq\u00a0r"]
    texts += ["".join(word() + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.choice([3, 40, 200]))) for _ in range(40)]
    texts += [" ".join(f"w{rng.randrange(10_000)}" for _ in range(120)) for _ in range(5)]
    return texts


def test_base_counts_match_brute_force(spark):
    texts = cases()
    rows = [(i // 2 if i % 5 else None, t, "en", "clash") for i, t in enumerate(texts)]
    rows.append(rows[-1])
    df = spark.createDataFrame(rows, SCHEMA)
    got = risk.base_counts(df.select(F.struct("doc_id", "lang").alias("k"), "text")).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(tuple(r[c] for c in cols) for r in got) == sorted(brute(t) for _, t, *_ in rows)
    labels = spark.createDataFrame([], LABELS)
    judged = risk.judge(df, labels).collect()
    assert len(judged) == len(rows) and all(r.kept == (not r.base_failed) for r in judged)


def test_binomial_tail_is_exact(spark):
    cases_ = [(1, 0), (30, 0), (30, 1), (700, 3), (20_000, 60), (100_000, 300), (50, 49)]
    df = spark.createDataFrame(cases_, "n long, k long").select("n", "k", risk.binomial_tail(F.col("n"), F.col("k"), 0.005).alias("p"))
    for r in df.collect():
        if r.k >= r.n * 0.005:
            assert r.p == 1.0
        else:
            log = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.005)
                   + (r.n - i) * math.log(0.995) for i in range(r.k + 1)]
            assert math.isclose(r.p, sum(map(math.exp, log)), rel_tol=1e-6)


def test_rejects_bad_and_bounds_false_rejection(spark):
    rng = random.Random(5)
    clean = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60))
    rows, labels = [], []
    for i in range(6000):
        bad = rng.random() < 0.25
        lang = rng.choice(["en", None, "rare"]) if i < 5900 else "few"
        text = clean()
        rows.append((i, text.replace(" ", "*** ") if bad else text, lang, "c"))
        if rng.random() < 0.9:
            labels.append((i, int(not bad)))
    labels += [(1, None), (None, 1), labels[0]]
    out = {r.doc_id: r for r in risk.judge(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS),
                                           alpha=0.1).collect()}
    for stratum in ("en", None, "rare", "few"):
        own = [r for r in rows if r[2] == stratum]
        good = [out[r[0]].kept for r in own if "***" not in r[1]]
        junk = [out[r[0]].kept for r in own if "***" in r[1]]
        assert sum(good) >= 0.9 * len(good)
        # too few labelled rows: nothing may be rejected; otherwise all the junk goes
        assert all(junk) if stratum == "few" else not any(junk)


def tail(n, k, p):
    return 1.0 if k >= n * p else sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


def brute_choice(rows, quantiles, alpha, delta):
    """Cutoffs per stratum, step by step on the rows themselves."""
    chains = {}
    for stratum in {r["stratum"] for r in rows}:
        fit = [r for r in rows if r["stratum"] == stratum and not r["holdout"]]
        steps = []
        for rule in risk.RULES:
            rates = sorted(r[rule] for r in fit)
            cuts = {rates[max(0, math.ceil(q * len(rates)) - 1)] for q in quantiles} if rates else ()
            price = 0.0
            for cut in sorted(cuts, reverse=True):
                good, bad = (sum(r["quality"] == y and r[rule] > cut for r in fit) for y in (1, 0))
                if bad:
                    price = max(price, (good + 0.5) / bad)
                    steps.append((price, rule, -cut))
        if steps:
            chains[stratum] = [(rule, -cut) for _, rule, cut in sorted(steps)]
    found = {}
    for stratum, steps in chains.items():
        own = [r for r in rows if r["stratum"] == stratum]
        good, best = [r for r in own if r["holdout"] and r["quality"] == 1], (0, None)
        for i in range(1, len(steps) + 1):
            gone = lambda r: any(r[rule] > cut for rule, cut in steps[:i])  # noqa: B023, E731
            if not good or tail(len(good), sum(map(gone, good)), alpha) > delta / len(chains):
                break
            bad = sum(gone(r) for r in own if not r["holdout"] and r["quality"] == 0)
            if bad > best[0]:
                best = (bad, i)
        if best[1]:
            found[stratum] = {}
            for rule, cut in steps[:best[1]]:
                found[stratum][rule] = min(cut, found[stratum].get(rule, cut))
    return found


def test_cutoffs_match_a_brute_force_choice(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = []
        for _ in range(1500):
            bad = rng.random() < 0.3
            mean = {"symbols": 6 if bad else 1, "lines": 3 if bad else 1, "repeats": 1, "length": 5}
            rows.append({"stratum": rng.choice(["en", "en", "de", None]), "quality": int(not bad),
                         "holdout": rng.random() < 0.6,
                         **{r: float(round(rng.expovariate(1 / m), rng.choice([0, 2]))) for r, m in mean.items()}})
        rows += [{"stratum": "one", "quality": 0, "holdout": False, **dict.fromkeys(risk.RULES, 1.0)},
                 {"stratum": "held", "quality": 1, "holdout": True, **dict.fromkeys(risk.RULES, 1.0)}]
        quantiles = (0.5, 0.8, 0.9, 0.95, 0.99)
        schema = "stratum string, quality int, holdout boolean, " + ", ".join(f"{r} double" for r in risk.RULES)
        df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).select(
            F.struct(F.col("stratum").alias("of")).alias("stratum"), "quality", "holdout", *risk.RULES)
        for alpha in (0.05, 0.2):
            got = {r.stratum["of"]: r.cutoffs for r in risk.thresholds(df, alpha, 0.1, quantiles).collect()}
            assert got == brute_choice(rows, quantiles, alpha, 0.1)
            if alpha == 0.2:
                assert set(got["en"]) >= {"symbols"}


def test_copies_have_one_vote_and_ids_with_two_labels_none(spark):
    rng = random.Random(9)
    good = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(60)]
    junk = [" ".join(f"w{rng.randrange(10 ** 6)}***" for _ in range(60)) for _ in range(60)]
    # 60 good texts are too few to reject anything at 2 %, however often they are repeated
    rows = [(i, t, "en", "c") for i, t in enumerate(good * 40 + junk)]
    labels = [(i, int(i < 2400)) for i in range(len(rows))]
    docs = spark.createDataFrame(rows, SCHEMA)
    judged = risk.judge(docs, spark.createDataFrame(labels, LABELS))
    assert all(r.kept for r in judged.collect())
    counts = risk.base_counts(docs.select("doc_id", F.struct(F.col("lang").alias("of")).alias("stratum"), "text"))
    rated = counts.select("*", *[c.alias(n) for n, c in risk.rates().items()])
    voted = risk.votes(rated.withColumn("quality", (F.col("doc_id") < 2400).cast("int")))
    assert {r.quality: r["count"] for r in voted.groupBy("quality").count().collect()} == {0: 60, 1: 60}
    # every junk text also labelled good: no label is left that could reject it
    distinct = [(i, t, "en", "c") for i, t in enumerate(
        [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(900)] + junk)]
    both = [(i, int(i < 900)) for i in range(960)]
    once = risk.judge(spark.createDataFrame(distinct, SCHEMA), spark.createDataFrame(both, LABELS))
    assert not any(r.kept for r in once.collect() if r.doc_id >= 900)
    both += [(i, 1) for i in range(900, 960)]
    twice = risk.judge(spark.createDataFrame(distinct, SCHEMA), spark.createDataFrame(both, LABELS))
    assert all(r.kept for r in twice.collect())


def test_empty(spark):
    assert risk.judge(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).count() == 0
