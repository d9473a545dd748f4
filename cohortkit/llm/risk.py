"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Each rule rejects a document whose rate (symbols per word, repeated lines per
word, repeated words per word, characters per word) exceeds a cutoff.  Cutoffs
are chosen per stratum (language).  Two fifths of the labelled rows
propose: their quantiles are the candidates, and all candidates of a stratum
form one sequence of steps, each of which adds a cutoff (the cheapest in good
rows for each bad one first, a rule's milder ones before its stricter ones).
The holdout, the other three fifths, decides by fixed-sequence testing: a step is valid if it and
all steps before it pass the exact binomial test
``P(Bin(n, alpha) <= k) <= delta / m``, where ``n`` counts the good rows, ``k``
those that the rules reject together after that step, and ``m`` the strata with
a sequence (Bonferroni).  The order is fixed before the holdout is looked at, so
a sequence needs no correction inside it, and the rules share one ``alpha``.
Of the valid steps the one after which most bad rows of the fitting part are
rejected is taken, the first of equals; a stratum without one rejects nothing.

So with probability ``1 - delta`` the thresholds reject, in every stratum, at
most the share ``alpha`` of the good documents that pass the base rule.  Copies
are not independent rows: labelled texts with the same smallest hash of a
three-word window have one vote per stratum and label, that of one row picked by
hash, and stand in one part; the share is one of such groups.

Defined results: NULL or wordless texts have zero counts and fail the base
rule; a NULL language is a stratum of its own; labels other than 0 and 1 are
ignored, repeated labels count once, an id labelled both 0 and 1 has no label; a
label holds for every document of its id; repeated documents are judged one by
one.  Labelled rows of both parts come from all labels, without a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import written

SPACE = " \t\n\x0b\f\r"
RULES = ("symbols", "lines", "repeats", "length")
QUANTILES = (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.925, 0.95, 0.96, 0.97, 0.98, 0.985, 0.99, 0.995, 0.999)
ALPHA = 0.02
DELTA = 0.05
_SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, "[ \t-\r]+"))


def _with_word_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def _starts_of_repeats(by_hash: str) -> Column:
    """Starts of windows whose hash occurs more than once, from the (hash, start)
    column sorted by hash: those with an equal neighbour."""
    last = F.size(by_hash) - 1
    return F.filter(F.transform(by_hash, lambda x, j: F.when(
        ((j > 0) & (F.get(by_hash, j - 1)["h"] == x["h"])) | ((j < last) & (F.get(by_hash, j + 1)["h"] == x["h"])),
        x["i"])), lambda i: i.isNotNull())


def _covered(starts: Column) -> Column:
    """Words under three-word windows at ``starts``: each adds three, or as many as
    lie after the one before it."""
    return F.aggregate(
        F.array_sort(starts),
        F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("at"), (acc["n"] + F.least(F.lit(3), i - acc["at"])).alias("n")),
        lambda acc: acc["n"])


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` (long), ``base_failed`` and ``copies``, the
    smallest hash of a three-word window (NULL without one)."""
    keep = [c for c in docs.columns if c != text]
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, _words(F.col(text)).alias("_words"), _with_word_lines(F.col(text)).alias("_lines"),
                       (F.length(t) - F.length(F.regexp_replace(t, _SYMBOLS, ""))).cast("long").alias("n_symbols"))
    starts = F.when(F.size("_words") > 2, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(
        F.array().cast("array<int>"))
    rows = rows.select(
        *keep, F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)))
        .alias("_windows"))
    rows = rows.withColumn("copies", F.array_min("_windows"))
    counts = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "copies"]
    # sorted only where some window repeats; each step is a column of its own, read by position
    rows = rows.select(*counts, F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_by_hash"))
    rows = rows.select(*counts, _starts_of_repeats("_by_hash").alias("_starts"))
    rows = rows.select(*counts, F.coalesce(_covered(F.col("_starts")), F.lit(0)).cast("long").alias("n_repeat_words"))
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def rates() -> dict[str, Column]:
    """Rule name to its rate, from the base counts."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {"symbols": F.col("n_symbols") / words, "lines": F.col("n_dup_lines") / words,
            "repeats": F.col("n_repeat_words") / words, "length": F.col("word_chars") / words}


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x * x * x) \
        + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k).  Terms are summed from ``k`` down, as far as they can
    matter in double precision; from the mean upwards the tail counts as 1."""
    n, k = n.cast("long"), k.cast("long")
    first = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)
                  + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    low = F.greatest(F.lit(0).cast("long"), k - (60 * (F.sqrt(k.cast("double")) + 10)).cast("long"))
    total = F.aggregate(
        F.sequence(k, low, F.lit(-1).cast("long")),
        F.struct(first.alias("term"), F.lit(0.0).alias("sum")),
        lambda acc, i: F.struct((acc["term"] * i * F.lit((1 - p) / p) / (n - i + 1)).alias("term"),
                                (acc["sum"] + acc["term"]).alias("sum")),
        lambda acc: acc["sum"])
    return F.when(k >= n * F.lit(p), F.lit(1.0)).otherwise(F.least(total, F.lit(1.0)))


def votes(labelled: DataFrame) -> DataFrame:
    """One row per group of copies of a stratum and label, with its part: ``stratum``,
    ``quality``, ``holdout`` and the rules' rates, from rows with ``doc_id`` and ``copies``."""
    one = labelled.groupBy("stratum", "quality", "copies").agg(
        F.min(F.struct(F.xxhash64("doc_id").alias("at"), *RULES)).alias("row"))
    return one.select("stratum", "quality", (F.pmod(F.xxhash64(F.lit("part"), "copies"), F.lit(5)) < 3).alias("holdout"),
                      *[F.col("row")[rule].alias(rule) for rule in RULES])


def sequence(fitting: DataFrame, quantiles=QUANTILES) -> DataFrame:
    """The steps of each stratum in the order they are tested: (stratum, rule, cutoff, step)."""
    long = fitting.select("stratum", "quality", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("rate")) for r in RULES])).alias("v")) \
        .select("stratum", "quality", "v.rule", "v.rate")
    cuts = long.groupBy("stratum", "rule").agg(F.array_sort(F.array_distinct(
        F.percentile_approx("rate", list(quantiles), 10_000))).alias("cuts"))
    # one count per interval between cutoffs, then sums over a handful of rows
    counted = long.join(cuts, ["stratum", "rule"]).select(
        "stratum", "rule", "cuts", "quality", F.size(F.filter("cuts", lambda c: c < F.col("rate"))).alias("bin")) \
        .groupBy("stratum", "rule", "cuts", "bin").agg(
            F.sum((F.col("quality") == 1).cast("long")).alias("good"),
            F.sum((F.col("quality") == 0).cast("long")).alias("bad"))
    bins = counted.groupBy("stratum", "rule", "cuts").agg(
        F.collect_list(F.struct("bin", "good", "bad")).alias("bins"))  # one per cutoff and one more
    over = lambda name: F.aggregate(
        F.filter("bins", lambda b: b["bin"] > F.col("at")), F.lit(0).cast("long"), lambda acc, b: acc + b[name])
    steps = bins.select("stratum", "rule", "bins", F.posexplode("cuts").alias("at", "cutoff")) \
        .select("stratum", "rule", "cutoff", over("good").alias("good"), over("bad").alias("bad")).filter("bad > 0")
    # windows over a stratum's candidates: a few dozen rows
    milder = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))
    steps = steps.withColumn("price", F.max((F.col("good") + 0.5) / F.col("bad")).over(milder))
    order = Window.partitionBy("stratum").orderBy("price", "rule", F.desc("cutoff"))
    return steps.select("stratum", "rule", "cutoff", F.row_number().over(order).alias("step"))


def thresholds(voted: DataFrame, alpha: float = ALPHA, delta: float = DELTA, quantiles=QUANTILES) -> DataFrame:
    """(stratum, cutoffs map) from rows of ``stratum``, ``quality``, ``holdout`` and
    one column per rule."""
    steps = written(sequence(voted.filter("NOT holdout"), quantiles), "risk-steps")
    m = max(1, steps.select("stratum").distinct().count())
    listed = steps.groupBy("stratum").agg(F.collect_list(F.struct("rule", "cutoff", "step")).alias("steps"))
    rates_ = F.create_map(*[part for r in RULES for part in (F.lit(r), F.col(r))])
    # the step that first rejects a row, by whichever rule
    hit = voted.join(listed, "stratum").withColumn("rates", rates_).withColumn("step", F.array_min(F.transform(
        F.filter("steps", lambda s: s["cutoff"] < F.col("rates")[s["rule"]]), lambda s: s["step"])))
    counted = hit.groupBy("stratum", "step").agg(
        F.sum((F.col("holdout") & (F.col("quality") == 1)).cast("long")).alias("good"),
        F.sum((~F.col("holdout") & (F.col("quality") == 0)).cast("long")).alias("bad"))
    whole = Window.partitionBy("stratum")
    so_far = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tests = counted.withColumn("n", F.sum("good").over(whole)).filter("step IS NOT NULL") \
        .withColumn("k", F.sum("good").over(so_far)).withColumn("bad", F.sum("bad").over(so_far))
    passed = (F.col("n") > 0) & (binomial_tail(F.col("n"), F.col("k"), alpha) <= delta / m)
    valid = tests.withColumn("failed", F.max((~passed).cast("int")).over(so_far)).filter("failed = 0")
    chosen = valid.groupBy("stratum").agg((-F.max(F.struct("bad", (-F.col("step")).alias("last")))["last"]).alias("last"))
    cutoffs = steps.join(chosen, "stratum").filter("step <= last").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
          quality: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per document: ``doc_id``, the base counts, ``base_failed``, the ``rejected_by``
    rules and ``kept``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.struct(F.col(stratum).alias("of")).alias("stratum"))
    counts = written(base_counts(rows), "base-counts")
    rated = counts.select("*", *[rate.alias(name) for name, rate in rates().items()])
    marked = labels.filter(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(quality).alias("quality"), F.max(quality).alias("other")) \
        .filter("quality = other").drop("other")
    voted = written(votes(rated.filter("NOT base_failed").join(marked, "doc_id")), "risk-votes")
    found = thresholds(voted, alpha, delta)
    judged = rated.join(found, "stratum", "left")
    hits = F.filter(F.array(*[F.when(F.col(r) > F.col("cutoffs")[r], F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    judged = judged.withColumn("rejected_by", F.coalesce(hits, F.array().cast("array<string>")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "rejected_by", (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"))
