"""Packing tokenised documents into sequences by a configuration linear program.

Documents become token pieces of at most ``capacity`` tokens.  The histogram of
piece lengths (at most ``capacity`` entries, whatever the corpus) is the
demand of a covering linear program over configurations, i.e. multisets of
lengths that fit a sequence.  Multiplicative weights solve it: every round a
knapsack dynamic program prices the configurations for the current dual
prices.  The fractional solution is rounded, the program is solved again for what
is left, and the few pieces that remain are packed best fit.

Spark then deals pieces to slots: the rank of a piece within its length is a
task-local counter plus a running sum over per-task counts, and ranks map onto
the bounded slot table of the plan.  Texts are never shuffled, only their
piece rows.

Defined results: a NULL text counts as empty (one piece: the end id alone);
repeated documents are packed once per row; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import worker_state, written

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS = 600_000


# a run of ASCII punctuation that closes a chunk, after an ASCII letter or digit
_CLOSING = re.compile(rb"(?<=[0-9a-z])([!#$%&()*+,./:;<=>?@\[\]^_{|}~-]+)(?=\s|\Z)")


class TokenBytes:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, it lower-cases,
    and it parts letters from punctuation.  So texts are lower-cased, closing
    punctuation is set apart, and ids are kept per white-space delimited chunk.
    New chunks of letters only are tokenised many at a time: the last token of
    a word carries the end-of-word mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def _chunks(text: bytes | None) -> list[bytes]:
        if not text:
            return []
        if b"<|" in text:  # may hold a special token's text, which counts as it stands
            return text.split()
        return _CLOSING.sub(rb" \1", text.lower()).split()

    def _learn(self, new: list[str]) -> None:
        words, odd = [], []
        for chunk in new:
            (words if chunk.isalpha() else odd).append(chunk)
        lots = [words[i:i + 200] for i in range(0, len(words), 200)]
        coded = self.tokenizer.encode_batch_fast([" ".join(lot) for lot in lots], add_special_tokens=False)
        for lot, enc in zip(lots, coded):
            ids = np.array(enc.ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
            if len(ends) != len(lot):
                odd += lot
                continue
            data, at = ids.tobytes(), 0
            for word, end in zip(lot, ends.tolist()):
                self.known[word.encode()] = data[at:end]
                at = end
        for chunk, enc in zip(odd, self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)):
            self.known[chunk.encode()] = np.array(enc.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        split = [self._chunks(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        self._learn([c.decode() for c in set().union(*split) if c not in known])
        return [b"".join([known[c] for c in chunks]) for chunks in split]


def coder(path: str) -> TokenBytes:
    return worker_state(f"tokens {path}", lambda: TokenBytes(path))


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           vocabulary: str | None = None) -> DataFrame:
    """One row per piece of every document: the document's ids and id 0, cut into
    ``capacity`` tokens where longer.  ``_task`` and ``_rank`` number the pieces of
    one length within the task that made them; the result is a written table."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = (f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, _task int, _rank bigint")
    cut = 4 * capacity

    def run(batches):
        own, seen, task = coder(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for key, tokens in zip(ids, own.encode(batch.column(1).to_pylist())):
                tokens += b"\0\0\0\0"
                for number, at in enumerate(range(0, len(tokens), cut)):
                    part = tokens[at:at + cut]
                    size = len(part) // 4
                    rows.append((key, number, at // 4, size, zlib.crc32(part), task, seen[size]))
                    seen[size] += 1
            columns = list(zip(*rows)) or [()] * 7
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "_task", "_rank"])

    made = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)
    return written(made, "pieces")


@dataclass(frozen=True)
class Plan:
    """``copies[i]`` sequences of the configuration ``parts[i]`` ((length, count) pairs, longest first)."""

    parts: list[tuple[tuple[int, int], ...]]
    copies: list[int]
    #: pieces placed by the linear program (and the full ones); the others by best fit
    by_program: int = 0


def _priced(lengths: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Unbounded knapsack: per room the highest total price of lengths that fit, the length
    taken first for it (-1: none) and the room left after it."""
    value = np.zeros(capacity + 1)
    pick, then = [-1] * (capacity + 1), [0] * (capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        fit = fits[room]
        total = value[room - lengths[:fit]] + price[:fit]
        best = int(total.argmax())
        if total[best] > value[room - 1]:
            value[room], pick[room], then[room] = total[best], best, room - int(lengths[best])
        else:
            value[room], pick[room], then[room] = value[room - 1], pick[room - 1], then[room - 1]
    return value, pick, then


def _fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int, epsilon: float,
                cover: int, near: float) -> dict[tuple, float]:
    """Multiplicative weights for the covering program: amounts of configurations ((length index,
    count) pairs).  They are found until every length is covered ``cover`` times, and each is
    divided by the most any of its lengths is covered, so none needs more pieces than there are.

    One knapsack prices all configurations: for each length the best one with it.
    Those within 1 - ``near`` of the best are taken, a length once a round, as
    often as their scarcest length allows; the prices of what they cover fall.  A
    length whose price stays while others fall is taken in the end, so the
    rounds needed do not depend on the number of pieces.
    """
    log_price = np.log(lengths / capacity)
    covered = np.zeros(len(lengths))
    taken: dict[tuple, float] = {}
    while covered.min() < cover:
        price = np.exp(log_price - log_price.max()) + 1e-12 * lengths
        value, pick, then = _priced(lengths, price, capacity)
        total = price + value[capacity - lengths]
        seen = np.zeros(len(lengths), bool)
        level = covered.min() + 1  # who is covered more comes in by its price alone
        order = np.argsort(-total, kind="stable")
        for first in order:
            if total[first] < (1 - near) * total.max():
                break
            if seen[first] or (covered[first] >= level and first != order[0]):
                continue
            found = Counter([int(first)])
            room = capacity - int(lengths[first])
            while pick[room] >= 0:
                found[pick[room]] += 1
                room = then[room]
            key = tuple(sorted(found.items(), reverse=True))
            index, count = np.array(key).T
            step = float((demand[index] / count).min())
            taken[key] = taken.get(key, 0.0) + step
            ratio = step * count / demand[index]
            covered[index] += ratio
            log_price[index] -= epsilon * ratio
            seen[index] = True
    return {key: amount / max(covered[i] for i, _ in key) for key, amount in taken.items()}


def solve(histogram: dict[int, int], capacity: int = CAPACITY, epsilon: float = 0.4, cover: int = 3,
          near: float = 0.01) -> Plan:
    """Configurations and copies that hold exactly the pieces of ``histogram``.

    The program's solution is rounded (down, but to one copy at least, as long as the pieces
    are left), and the program is solved again for what remains.  What a last
    solution can place less than a tenth of is packed best fit.
    """
    left = {int(k): int(v) for k, v in histogram.items() if v > 0}
    out: Counter = Counter()
    if left.get(capacity):
        out[((capacity, 1),)] += left.pop(capacity)
    while left:
        lengths = np.array(sorted(left), np.int64)
        taken = _fractional(lengths, np.array([left[int(k)] for k in lengths], float), capacity, epsilon, cover, near)
        before = sum(left.values())
        for key, amount in sorted(taken.items(), key=lambda kv: (-kv[1], kv[0])):
            part = tuple((int(lengths[i]), c) for i, c in key)
            whole = min(max(int(amount + 1e-9), 1), *(left.get(k, 0) // c for k, c in part))
            if whole > 0:
                out[part] += whole
                for k, c in part:
                    left[k] -= whole * c
                    if not left[k]:
                        del left[k]
        placed = before - sum(left.values())
        if placed * 10 < before:
            break
    by_program = sum(times * c for part, times in out.items() for _, c in part)
    out.update(_best_fit(left, capacity))
    return Plan(list(out), list(out.values()), by_program)


def _best_fit(left: dict[int, int], capacity: int) -> dict[tuple, int]:
    """Best fit on a histogram: open a sequence with the longest piece left, then
    keep adding the longest piece that fits; equal sequences are filled at once."""
    out: Counter = Counter()
    left = dict(left)
    while left:
        room, one = capacity, Counter()
        for size in sorted(left, reverse=True):
            n = min(left[size], room // size)
            if n:
                one[size] = n
                room -= n * size
            if not room:
                break
        times = min(left[k] // c for k, c in one.items())
        out[tuple(sorted(one.items(), reverse=True))] += times
        for k, c in one.items():
            left[k] -= times * c
            if not left[k]:
                del left[k]
    return out


def slots(plan: Plan) -> dict[int, np.ndarray]:
    """Per length the plan's slot ranges, in rank order: columns are the first rank,
    pieces per sequence, first sequence, offset of the first piece."""
    found: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for part, times in zip(plan.parts, plan.copies):
        offset = 0
        for size, count in part:
            found.setdefault(size, []).append((used[size], count, sequence, offset))
            used[size] += times * count
            offset += size * count
        sequence += times
    return {k: np.array(v, np.int64) for k, v in found.items()}


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (as :func:`pieces` wrote them) with ``sequence_id`` and ``offset``."""
    spark = made.sparkSession
    counts = made.groupBy("length", "_task").agg(F.count("*").alias("n"))
    # running count per length over the tasks: where each task's ranks start
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.withColumn("_first", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long")), "counts")
    histogram = {r.length: r.n for r in starts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(solve(histogram, capacity)))  # bounded by capacity and rounds
    ranked = made.join(starts.drop("n"), ["length", "_task"]) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_first")).alias("_rank"))
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    names = schema.names

    def run(batches):
        ranges = table.value
        for batch in batches:
            size = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.unique(size):
                at = np.flatnonzero(size == k)
                own = ranges[int(k)]
                row = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                inside = rank[at] - row[:, 0]
                sequence[at] = row[:, 2] + inside // row[:, 1]
                offset[at] = row[:, 3] + inside % row[:, 1] * k
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    return ranked.mapInArrow(run, schema)
