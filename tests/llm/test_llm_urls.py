import math
import re

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import urls

SCHEMA = "page_id long, url string, rule string"
URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?x=/fr/#t", "http://example.org/en/1", "http://xexample.org/en/2",
    "http://org", "http://org/", "http://a.b.com/fr/x", "http://b.com/de/7#x", "http://b.com/DE/7", "http://com/fr/", "x://y://z.com/de/",
    "http://cheap-pills.example.net/en/3", "http://library.example.net/en/3", "http://É.com/fr/a b", "ftp://u@h.net:80/p?q", "http://a.net/" + "z" * 20_000,
    "http://h.org?q=/x", "http://h.example.org/en/1?",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    best = None
    for verdict, rule in urls.RULES:
        site, _, rest = rule.partition("/")
        if (host == site or host.endswith("." + site)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best


@pytest.fixture(scope="module")
def model(spark):
    return urls.train(spark.createDataFrame(list(urls.LABELLED), "url string, label int"))


def test_rules_and_parts_match_brute_force(spark, model):
    rows = [(i, u, "clash") for i, u in enumerate(URLS)] + [(0, URLS[4], "clash")]
    out = urls.judge(spark.createDataFrame(rows, SCHEMA), model).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.host, r.path) == split(r.url)
        best = ruled(r.host, r.path)
        assert r.rule == (best[1] if best else None)
        if best:
            assert r.verdict == best[0]
    by_url = {r.url: r.verdict for r in out}
    assert by_url["http://cheap-pills.example.net/en/3"] == "block"
    assert by_url["http://library.example.net/en/3"] == "allow"
    assert by_url[None] == by_url[""] == "allow"


def test_model_is_the_logistic_regression_of_its_table(spark, model):
    labelled = spark.createDataFrame(list(urls.LABELLED), "url string, label int")
    rows = urls.with_features(labelled).collect()
    x = [(set(r["__ck_grams"]), r.label) for r in rows]
    w, b, n = {}, 0.0, len(x)
    for _ in range(urls.STEPS):
        res = []
        for grams, y in x:
            f = b + sum(w.get(g, 0.0) for g in grams) / math.sqrt(max(1, len(grams)))
            res.append(1 / (1 + math.exp(-f)) - y)
        w = {g: v * (1 - urls.RATE * urls.RIDGE) for g, v in w.items()}
        for (grams, _), r in zip(x, res):
            for g in grams:
                w[g] = w.get(g, 0.0) - urls.RATE * r / n / math.sqrt(max(1, len(grams)))
        b -= urls.RATE * sum(res) / n
    assert model.bias == pytest.approx(b, abs=1e-6)
    assert model.weights == pytest.approx(w, abs=1e-6)
    scored = urls.with_features(labelled).select("label", (model.margin(F.col("__ck_grams")) >= 0).alias("hit")).collect()
    assert all(r.hit == (r.label == 1) for r in scored)


def test_empty_tables(spark, model):
    assert urls.judge(spark.createDataFrame([], SCHEMA), model).count() == 0
    assert urls.train(spark.createDataFrame([], "url string, label int")).weights == {}
