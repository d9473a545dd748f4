"""Toxicity: character n-gram linear classifier on naive Bayes log-count ratios.

Presence of hashed character n-grams, each scaled by its log-count ratio
between the two classes (estimated on the training rows), goes into an
L2-regularised logistic regression.  Ratios are shrunk by ``1 - log(n) / G``, with
``G`` the likelihood-ratio statistic of bucket and class over ``n`` votes: absence
from one class counts as what it is, and a bucket for which equal rates are the
likelier model (by Schwarz's criterion) gets 0, so a very long clean text
gathers none.  No other limit holds on buckets; the penalty weighs the rest.

Training uses a bounded, deterministic sample: the ``max_per_class`` labelled
rows of each class with the smallest hash of their id.  Only that sample is
broadcast (ids) and gathered (texts, in one task); scoring reads every row in
place, without a shuffle.

Defined results: NULL and empty texts get the score of a text without
n-grams; rows without a label or with a NULL label teach nothing; with one
class only, or no labelled rows, every score is the share of label 1 (0
without rows).  Rows with equal training texts count as one text.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import crc_fold, with_column, worker_state
from cohortkit.llm.ngrams import buckets, code_points, present

ORDERS = (3, 4, 5, 6)
BITS = 20
MAX_PER_CLASS = 2_500


@dataclass(frozen=True)
class Model:
    """``score = sigmoid(bias + sum of weights of the buckets present)``."""

    bias: float
    index: np.ndarray  # buckets with a weight, ascending
    weight: np.ndarray
    orders: tuple[int, ...] = ORDERS
    bits: int = BITS

    def scores(self, texts: list[bytes | None]) -> list[float]:
        chosen = np.zeros(1 << self.bits, bool)
        chosen[self.index] = True
        out = []
        for text in texts:
            found = [b[chosen[b]] for _, b in buckets(code_points(text), self.orders, self.bits)]
            hit = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
            margin = self.bias + float(self.weight[np.searchsorted(self.index, hit)].sum())
            out.append(1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, margin)))))
        return out


def fit(texts: list[bytes | None], labels: list[int], share: float | None = None, orders=ORDERS, bits=BITS,
        smoothing: float = 1.0, ridge: float = 0.01, steps: int = 400) -> Model:
    """Train on texts with 0/1 labels; ``share`` is the share of label 1 among all
    labelled rows, for samples drawn per class.  Near copies share one vote."""
    unique = list(dict.fromkeys((text or b"", int(label)) for text, label in zip(texts, labels)))
    y = np.array([label for _, label in unique], float)
    vote = _votes(unique)
    n1, n0 = float(vote[y > 0].sum()), float(vote[y == 0].sum())
    nothing = np.empty(0, np.int64)
    if not n1 or not n0:
        base = (1.0 if n1 else 0.0) if share is None or not len(y) else share
        odds = math.log(max(base, 1e-9) / max(1 - base, 1e-9))
        return Model(odds, nothing, np.empty(0), orders, bits)
    share = n1 / (n1 + n0) if share is None else min(max(share, 1e-6), 1 - 1e-6)
    df1, df0 = np.zeros(1 << bits), np.zeros(1 << bits)
    for (text, label), v in zip(unique, vote):
        (df1 if label else df0)[present(code_points(text), orders, bits)] += v
    n = n1 + n0
    p, q = df1 + 2 * smoothing * n1 / n, df0 + 2 * smoothing * n0 / n  # unseen: equal rates
    ratio = np.log(p / (n1 + 2 * smoothing)) - np.log(q / (n0 + 2 * smoothing))
    found = _evidence(df1, df0, n1, n0)
    index = np.flatnonzero(found > math.log(n))
    if not len(index):
        return Model(math.log(share / (1 - share)), nothing, np.empty(0), orders, bits)
    ratio = ratio[index] * (1 - math.log(n) / found[index])
    # a second look at the texts: all their n-grams at once would not fit a worker
    column = np.full(1 << bits, -1, np.int32)
    column[index] = np.arange(len(index))
    rows = []
    for text, _ in unique:
        at = column[present(code_points(text), orders, bits)]
        rows.append(at[at >= 0])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(at) for at in rows])
    at = np.concatenate(rows)
    norms = np.bincount(row, weights=(ratio * ratio)[at], minlength=len(rows))
    scale = 1.0 / max(1.0, math.sqrt(float(norms.max())))
    ratio *= scale
    # class weights restore the share of label 1 among all labelled rows
    weight = np.where(y > 0, share / n1, (1 - share) / n0) * vote * len(y)
    penalty = np.full(len(index) + 1, ridge / len(y))
    penalty[-1] = 0.0
    w = np.zeros(len(index) + 1)
    w[-1] = math.log(share / (1 - share))
    # gradient descent with Nesterov steps; the rows have norm at most sqrt(2)
    rate = 1.0 / (0.25 * float((weight * (norms * scale * scale + 1.0)).sum()) / len(y) + penalty.max())
    z, t = w.copy(), 1.0
    for _ in range(steps):
        with np.errstate(over="ignore"):
            pred = 1 / (1 + np.exp(-(np.bincount(row, weights=(z[:-1] * ratio)[at], minlength=len(y)) + z[-1])))
        miss = weight * (pred - y) / len(y)
        grad = np.append(np.bincount(at, weights=miss[row], minlength=len(index)) * ratio, miss.sum()) + penalty * z
        new = z - rate * grad
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        done = np.abs(new - w).max() < 1e-7
        w, t = new, t_new
        if done:
            break
    return Model(float(w[-1]), index, w[:-1] * ratio, orders, bits)


def _evidence(df1: np.ndarray, df0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Likelihood-ratio statistic ``G`` of each bucket's presence against the class."""
    n = n1 + n0
    both = df1 + df0
    out = np.zeros(len(both))
    for seen, of, total in ((df1, n1, both), (df0, n0, both), (n1 - df1, n1, n - both), (n0 - df0, n0, n - both)):
        some = seen > 1e-9
        out[some] += 2 * seen[some] * np.log(seen[some] * n / (of * total[some]))
    return out


def _votes(unique: list[tuple[bytes, int]], width: int = 5, sketches: int = 4) -> np.ndarray:
    """1 / size of each text's group of near copies with the same label (texts
    that share the smallest hash of their word shingles under one of a few hashes)."""
    parent = list(range(len(unique)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    first: dict[tuple, int] = {}
    for i, (text, label) in enumerate(unique):
        words = text.split()
        grams = {b" ".join(words[j:j + width]) for j in range(max(1, len(words) - width + 1))}
        for seed in range(sketches):
            key = (label, seed, min(xxhash.xxh3_64_intdigest(g, seed) for g in grams))
            parent[root(i)] = root(first.setdefault(key, i))
    roots = [root(i) for i in range(len(unique))]
    size = Counter(roots)
    return np.array([1.0 / size[r] for r in roots])


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
           max_per_class: int = MAX_PER_CLASS) -> tuple[list, float]:
    """Ids and labels of the training sample (at most ``2 * max_per_class``), and
    the share of label 1 among all training rows."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & (crc_fold(F.col(doc_id)) != 0)) \
        .select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = []
    for y in (0, 1):
        picked += rows.filter(F.col("y") == y).distinct().orderBy(F.xxhash64("id"), "id").limit(max_per_class).collect()
    total = sum(counts.values())
    return [(r.id, r.y) for r in picked], (counts.get(1, 0) / total if total else 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text",
          max_per_class: int = MAX_PER_CLASS) -> Model:
    """Fit on the labelled rows whose id is not in fold 0, in one task over the
    bounded sample."""
    spark = docs.sparkSession
    chosen, share = sample(docs, labels, label, doc_id, max_per_class)
    if not chosen:
        return Model(math.log(1e-9), np.empty(0, np.int64), np.empty(0))
    ids = spark.createDataFrame(chosen, T.StructType([
        T.StructField("_id", docs.schema[doc_id].dataType), T.StructField("_y", T.IntegerType())]))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("binary").alias("_text")) \
        .join(F.broadcast(ids), "_id").select("_text", "_y")

    def run(batches):
        worker_state("toxicity", dict)
        texts, ys = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            ys += batch.column(1).to_pylist()
        order = sorted(range(len(ys)), key=lambda i: (texts[i] or b"", ys[i]))  # the same fit for any row order
        model = fit([texts[i] for i in order], [ys[i] for i in order], share)
        yield pa.RecordBatch.from_arrays([
            pa.array([model.bias]), pa.array([model.index.tolist()], pa.list_(pa.int64())),
            pa.array([model.weight.tolist()], pa.list_(pa.float64()))], names=["bias", "buckets", "weights"])

    fitted = rows.repartition(1).mapInArrow(run, "bias double, buckets array<bigint>, weights array<double>").collect()
    if not fitted:  # no labelled id is among the documents
        return fit([], [])
    row = fitted[0]
    return Model(row.bias, np.array(row.buckets, np.int64), np.array(row.weights, float))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score in column ``name``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS weights
    return with_column(docs, text, name, T.DoubleType(), lambda texts: shared.value.scores(texts))
