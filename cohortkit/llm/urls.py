"""URL filter: path rules first, then logistic regression on hashed n-grams.

DataFrame functions only.  Features are the distinct hashed character n-grams
of host and path.  The labelled table is small by contract (``MAX_LABELLED``
rows, checked), so training is one row: gradient descent runs over the Gram
matrix of the labelled URLs inside one ``aggregate`` expression, and the
resulting weights (at most ``2**BITS``) become an array literal that scores
every page in place, without a shuffle.

Defined results: a NULL URL or one without ``://`` has empty host and path,
fits no rule and gets the verdict of the bias alone; of several fitting rules
the longest wins; repeated pages are judged one by one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import written

BITS = 14
ORDERS = (3, 4, 5)
MAX_LABELLED = 2_000
STEPS = 300
RATE = 2.0
RIDGE = 1e-3

#: The rules of the contract, (verdict, host and path prefix).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: The labelled URL table, 1 for sites to block.
LABELLED = (
    ("https://cheap-meds.example.com/en/1", 1),
    ("http://www.best-pills.example.net/buy/12", 1),
    ("https://pills-online.example.org/shop/4", 1),
    ("http://online-casino.example.com/en/77", 1),
    ("https://m.casino-royal.example.net/win/9", 1),
    ("http://win-big-casino.example.org/fr/3", 1),
    ("https://sport-bets.example.net/en/18", 1),
    ("http://www.free-bets-now.example.com/odds/5", 1),
    ("https://bets-online.example.org/en/260", 1),
    ("http://adult-chat.example.com/en/40", 1),
    ("https://www.adult-x-videos.example.net/de/7", 1),
    ("http://m.adult-dating.example.org/en/31", 1),
    ("https://spam-links.example.com/es/602", 1),
    ("http://link-spam-farm.example.net/en/55", 1),
    ("http://www.content-farm.example.org/en/81", 1),
    ("https://ads-server.example.com/en/9", 1),
    ("http://ad-track.example.net/pixel/1", 1),
    ("https://track-ads.example.org/en/14", 1),
    ("https://free-win.example.com/en/333", 1),
    ("http://cheap-loans.example.net/fr/71", 1),
    ("http://blog.casino-tips.example.com/en/5", 1),
    ("https://blog.adult-stories.example.net/en/44", 1),
    ("", 0),
    ("https://www.citylibrary.example.org/en/10", 0),
    ("http://blog.gardening.example.net/en/503", 0),
    ("https://university.example.org/fr/825", 0),
    ("http://news.example.com/en/676", 0),
    ("https://m.weather.example.net/en/25", 0),
    ("https://museum.example.org/de/685", 0),
    ("http://www.railways.example.com/de/144.html", 0),
    ("https://blog.kitchen.example.net/es/633", 0),
    ("https://thesis.example.org/en/233", 0),
    ("http://physics.example.com/fr/92.html", 0),
    ("https://blog.history.example.net/de/945", 0),
    ("http://www.theatre.example.com/en/270", 0),
    ("https://nature.example.org/en/584", 0),
    ("http://blog.reading.example.net/fr/10", 0),
    ("https://www.housing.example.com/en/854/", 0),
    ("http://m.thunder.example.net/en/673/", 0),
    ("https://other.example.org/es/245", 0),
    ("http://blog.station.example.com/en/722", 0),
    ("https://therapy.example.net/en/770", 0),
    ("http://mathematics.example.com/en/847", 0),
    ("https://www.heritage.example.net/fr/510", 0),
    ("http://northern.example.org/en/297", 0),
    ("https://teacher.example.com/es/401", 0),
    ("http://blog.ocean.example.net/en/381", 0),
    ("https://www.tennis.example.org/en/196/", 0),
    ("http://m.recipes.example.com/fr/176", 0),
    ("https://forest.example.net/de/839", 0),
    ("http://www.astronomy.example.com/en/756", 0),
    ("https://hospital.example.net/en/12", 0),
    ("http://parliament.example.org/fr/58", 0),
    ("https://www.economics.example.net/es/964", 0),
    ("http://blog.music.example.com/de/330", 0),
    ("https://painting.example.net/en/418", 0),
    ("http://language.example.org/en/872", 0),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, NULL without one."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(slash + rest))
        found.append((fits, rule, verdict))
    return (F.coalesce(*[F.when(fits, F.lit(rule)) for fits, rule, _ in found]),
            F.coalesce(*[F.when(fits, F.lit(verdict)) for fits, _, verdict in found]))


def _chars(column: str) -> Column:
    return F.concat(F.array(F.lit("^")), F.filter(F.split(column, ""), lambda c: c != ""), F.array(F.lit("$")))


def _grams(part: str, chars: str, n: int) -> Column:
    """Buckets of the n-grams of an array column of characters."""
    starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.pmod(
        F.xxhash64(F.lit(part), *[F.get(chars, i + k) for k in range(n)]), F.lit(1 << BITS)).cast("int"))


def with_features(rows: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` plus ``host``, ``path`` and ``__ck_grams`` (distinct buckets)."""
    host, path = host_and_path(F.col(url))
    rows = rows.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))})
    rows = rows.withColumns({"__ck_h": _chars("host"), "__ck_p": _chars("path")})
    grams = [_grams(part, chars, n) for part, chars in (("h", "__ck_h"), ("p", "__ck_p")) for n in ORDERS]
    return rows.withColumn("__ck_grams", F.array_distinct(F.flatten(F.array(*grams)))).drop("__ck_h", "__ck_p")


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]

    def margin(self, grams: Column) -> Column:
        dense = [round(self.weights.get(i, 0.0), 9) for i in range(1 << BITS)]
        weight = F.from_json(F.lit(json.dumps(dense)), T.ArrayType(T.DoubleType()))  # folded to a literal
        total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(weight, g))
        return F.lit(self.bias) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def train(labelled: DataFrame, url: str = "url", label: str = "label") -> Model:
    """Logistic regression on the labelled URLs (label 1: block)."""
    rows = with_features(labelled.filter(F.col(label).isin(0, 1)).select(
        F.col(url).alias("url"), F.col(label).cast("double").alias("y"))).select("url", "y", "__ck_grams")
    size = rows.count()
    if size > MAX_LABELLED:
        raise ValueError(f"{size} labelled URLs; this trainer takes {MAX_LABELLED}")
    if not size:
        return Model(-1.0, {})
    one = rows.agg(F.array_sort(F.collect_list(F.struct("url", "y", F.col("__ck_grams").alias("x")))).alias("rows"))
    norm = lambda r: F.sqrt(F.greatest(F.size(r["x"]), F.lit(1)).cast("double"))
    one = one.select("rows", F.transform("rows", lambda a: F.transform("rows", lambda b: F.size(
        F.array_intersect(a["x"], b["x"])) / (norm(a) * norm(b)))).alias("gram"))
    one = written(one, "gram")  # else the plan would compute the matrix anew in every step
    start = F.struct(F.transform("rows", lambda r: F.lit(0.0)).alias("a"), F.lit(0.0).alias("b"))

    def residuals(state):
        return F.transform("rows", lambda r, i: F.lit(1.0) / (F.lit(1.0) + F.exp(-(state["b"] + F.aggregate(
            F.zip_with(F.get("gram", i), state["a"], lambda k, a: k * a), F.lit(0.0), lambda acc, v: acc + v)))) - r["y"])

    def move(pair):
        return F.struct(
            F.zip_with(pair["a"], pair["r"], lambda a, r: a - F.lit(RATE) * (r / size + F.lit(RIDGE) * a)).alias("a"),
            (pair["b"] - F.lit(RATE) * F.aggregate(pair["r"], F.lit(0.0), lambda acc, v: acc + v) / size).alias("b"))

    def step(state, _):
        # one-element array: the residuals are computed once and used twice
        held = F.transform(F.array(state), lambda s: F.struct(
            s["a"].alias("a"), s["b"].alias("b"), residuals(s).alias("r")))
        return F.get(F.transform(held, move), F.lit(0))

    fitted = one.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step).alias("m"))
    bias = fitted.select(F.col("m.b").alias("b")).collect()[0].b
    pairs = fitted.select(F.posexplode("rows").alias("i", "r"), F.col("m.a").alias("a")) \
        .select((F.get("a", F.col("i")) / norm(F.col("r"))).alias("w"), F.explode("r.x").alias("bucket"))
    weights = {r.bucket: r.w for r in pairs.groupBy("bucket").agg(F.sum("w").alias("w")).collect()}  # at most 2**BITS
    return Model(bias, weights)


def judge(pages: DataFrame, model: Model, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule``, ``verdict`` (same-named columns are replaced)."""
    rows = with_features(pages, url)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__ck_ruled": verdict})
    learnt = F.when(model.margin(F.col("__ck_grams")) >= 0, "block").otherwise("allow")
    return rows.withColumn("verdict", F.when(F.col("__ck_ruled").isNotNull(), F.col("__ck_ruled")).otherwise(learnt)) \
        .drop("__ck_ruled", "__ck_grams")
