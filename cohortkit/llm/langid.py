"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (n = 1 to 4, a
blended spectrum) present in both, divided by the geometric mean of their own
counts.  Nystrom features are the kernel values against a bounded set of
landmark texts, whitened; a ridge regression per language (one against the
rest) is solved on them.  Scoring multiplies batches of presence rows with the
landmark matrix.

Learning takes a bounded, deterministic sample of the labelled rows:
``per_language`` rows of each language (smallest hash of id and text), of which the
first ``landmarks / languages`` are landmarks.  Every row is scored in place.

Defined results: ``und`` with score 0 for a NULL text, a text without a
letter, or when nothing was learnt; ties go to the first language in
alphabetical order; rows without a language teach nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import crc_fold, with_column
from cohortkit.llm.ngrams import code_points, present

ORDERS = (1, 2, 3, 4)
BITS = 14
PER_LANGUAGE = 400
LANDMARKS = 160
MAX_LANGUAGES = 400
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def presence(texts: list[bytes | None], orders=ORDERS, bits=BITS) -> np.ndarray:
    """0/1 matrix of texts by buckets, rows scaled to unit length."""
    out = np.zeros((len(texts), 1 << bits), np.float32)
    for i, text in enumerate(texts):
        found = present(code_points(text), orders, bits)
        if len(found):
            out[i, found] = 1.0 / np.sqrt(len(found))
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    landmarks: np.ndarray  # buckets x landmarks
    weights: np.ndarray  # landmarks x languages, whitening included
    offset: np.ndarray

    def predict(self, texts: list[bytes | None], block: int = 128) -> list[dict]:
        out: list[dict] = []
        for start in range(0, len(texts), block):
            part = texts[start:start + block]
            known = [bool(t) and _LETTER.search(t.decode("utf-8", "replace")) is not None for t in part]
            if not self.languages:
                out += [{"lang": UNKNOWN, "score": 0.0}] * len(part)
                continue
            values = (presence(part) @ self.landmarks) @ self.weights + self.offset
            for ok, row in zip(known, values):
                best = int(np.argmax(row))
                out.append({"lang": self.languages[best], "score": float(min(1.0, max(0.0, (1 + row[best]) / 2)))}
                           if ok else {"lang": UNKNOWN, "score": 0.0})
        return out


def fit(texts: list[bytes], languages: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Model:
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    each = max(1, landmarks // len(names))
    marks: list[bytes] = []
    for name in names:
        # landmarks have to be informative: the longer half of a language's texts comes first
        own = [t for t, lang in zip(texts, languages) if lang == name]
        middle = sorted(len(t) for t in own)[len(own) // 2]
        marks += ([t for t in own if len(t) >= middle] + [t for t in own if len(t) < middle])[:each]
    base = presence(marks)
    gram = (base @ base.T).astype(float)
    values, vectors = np.linalg.eigh(gram)
    keep = values > 1e-6 * max(values.max(), 1e-12)
    white = vectors[:, keep] / np.sqrt(values[keep])  # Nystrom map: K(x, landmarks) -> features
    feats = np.concatenate([presence(texts[i:i + 128]) @ base.T for i in range(0, len(texts), 128)]) @ white
    y = np.array([[1.0 if lang == name else -1.0 for name in names] for lang in languages])
    mean, y_mean = feats.mean(0), y.mean(0)
    centred = feats - mean
    solved = np.linalg.solve(centred.T @ centred + ridge * len(texts) * np.eye(white.shape[1]), centred.T @ (y - y_mean))
    return Model(names, np.ascontiguousarray(base.T), (white @ solved).astype(np.float32),
                 (y_mean - mean @ solved).astype(np.float32))


def train(docs: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text",
          per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model:
    """Fit on rows of the other folds with a language and a letter, in one task
    over the bounded sample.  More than ``MAX_LANGUAGES`` values raise an error."""
    rows = docs.filter(F.col(lang).isNotNull() & (crc_fold(F.col(doc_id)) != 0) & F.col(text).rlike(r"\p{L}")) \
        .select(F.col(lang).alias("_lang"), F.col(text).cast("binary").alias("_text"),
                F.xxhash64(doc_id, F.lit(1)).alias("_h"))
    counts = rows.groupBy("_lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return fit([], [])
    # rows below a hash bound per language: about twice the wanted number, then exactly that many
    span = 2.0 ** 64
    bounds = {r._lang: -(2.0 ** 63) + span * min(1.0, (2 * per_language + 50) / r.n) for r in counts}
    limit = F.create_map(*[F.lit(v) for pair in bounds.items() for v in pair])
    near = rows.filter(F.col("_h").cast("double") <= limit[F.col("_lang")])
    order = Window.partitionBy("_lang").orderBy("_h", "_text")
    picked = near.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_language)

    def run(batches):
        got = [(lang, n, t) for b in batches for lang, n, t in zip(*[b.column(i).to_pylist() for i in range(3)])]
        got.sort(key=lambda r: (r[0], r[1]))
        model = fit([r[2] for r in got], [r[0] for r in got], landmarks)
        yield pa.RecordBatch.from_arrays([
            pa.array([model.languages]), pa.array([model.landmarks.tobytes()]), pa.array([model.weights.tobytes()]),
            pa.array([model.offset.tobytes()])], names=["languages", "landmarks", "weights", "offset"])

    row = picked.select("_lang", "_n", "_text").repartition(1).mapInArrow(
        run, "languages array<string>, landmarks binary, weights binary, offset binary").collect()[0]
    names = list(row.languages)
    return Model(names, np.frombuffer(bytes(row.landmarks), np.float32).reshape(1 << BITS, -1),
                 np.frombuffer(bytes(row.weights), np.float32).reshape(-1, len(names)),
                 np.frombuffer(bytes(row.offset), np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text", name: str = "prediction") -> DataFrame:
    """``docs`` with a struct column ``name`` of ``lang`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x landmarks
    return with_column(docs, text, name, RESULT, lambda texts: shared.value.predict(texts))
