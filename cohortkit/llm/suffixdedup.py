"""Exact substring deduplication by column-wise suffix ordering.

A byte is removed when a string of ``SIZE`` bytes that covers it also starts
earlier (smaller id, or earlier in the same document), judged on the input.

1. Texts are cut into runs of neighbouring windows that share a content-defined
   anchor (:mod:`cohortkit.llm.windows`).  Equal windows lie in runs with equal
   keys, at the same distance from the anchor.
2. Runs meet by key.  Runs with equal bytes are one segment: its earliest run
   stands for it and the others are repeats as a whole.  Segments that share
   their key with no other segment are done.
3. The others form multi-document collections, lined up at their anchors.  The
   collection's Burrows-Wheeler columns and common prefixes are built column by
   column from the right: each round inserts one symbol per segment, which
   re-sorts the suffixes stably by that symbol and renews the common prefixes
   of neighbours.  Columns are kept in an external file, laid down block by
   block and read back one column a round, so a task holds a few numbers per
   segment, not their bytes.  Neighbours with a common prefix of ``SIZE`` are
   equal windows, and all but the earliest are repeats.
4. Repeats become spans per document, and spans leave the texts.

Defined results: NULL texts count as empty; texts shorter than ``SIZE`` stay
whole; a NULL id comes after all others; rows that repeat an id are taken as
versions of one document (a string at the same place in two of them is no
repeat of itself), so equal rows come out equal; a text of 2^30 bytes or more
is an error.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import worker_state, written
from cohortkit.llm.windows import SPAN, Runs

SIZE = 100
BATCH_BYTES = 2_000_000
BLOCK = 4096
LAST = (1 << 63) - 1
MAX_TEXT = 1 << 30  # bytes; a run's start has 30 bits
MAX_BROADCAST = 100_000  # ids of several texts (8 bytes each) that are broadcast
# one long per run: start (30 bits), second hash of the text (20), windows - 1 (6), anchor - start (6), repeat (1)
_HASH_BITS = 20


def _pack(start, salt, windows, lead, repeat):
    return ((((start << 20) | salt) << 13) | ((windows - 1) << 7) | (lead << 1) | repeat).astype(np.int64)


def _unpack(at: np.ndarray):
    return at >> 33, (at >> 13) & 0xFFFFF, ((at >> 7) & 63) + 1, (at >> 1) & 63, at & 1


def _salt():
    """The salt in a run's ``at``."""
    return F.shiftright("at", 13).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, mark, salt, text): 64 bits of one hash and 20 of another tell the texts of an
    id apart, and those of all rows without one; both are 0 where an id has one text.

    Every run carries them through the shuffle, where zeros cost next to nothing.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    hashes = {"mark": F.xxhash64(body), "salt": F.xxhash64(F.lit(_HASH_BITS), body).bitwiseAND(F.lit((1 << _HASH_BITS) - 1))}
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"), body.cast("binary").alias("text"),
                       *[h.alias(name) for name, h in hashes.items()])
    several = written(rows.where(F.col("doc") != LAST).groupBy("doc").agg(
        *[f(name).alias(f"{f.__name__}_{name}") for name in hashes for f in (F.min, F.max)])
        .where("min_mark <> max_mark OR min_salt <> max_salt").select("doc", F.lit(True).alias("several")), "several")
    n = several.count()
    if n:
        rows = rows.join(F.broadcast(several) if n <= MAX_BROADCAST else several, "doc", "left")
        told = F.col("several").isNotNull() | (F.col("doc") == LAST)
    else:
        told = F.col("doc") == LAST
    return rows.select("doc", *[F.when(told, F.col(c)).otherwise(F.lit(0)).alias(c) for c in hashes], "text")


def _runs(keyed: DataFrame, size: int) -> DataFrame:
    """(k, seg, doc, mark, at) of every run.  Runs that repeat an earlier one of their batch
    are marked and dealt out at random: they need not meet anyone."""

    def run(batches):
        finder = worker_state(f"runs {size}", lambda: Runs(size))

        def found(docs, marks, salts, texts):
            text, start, windows, lead, key, seg = finder(texts)
            doc, mark, salt = docs[text], marks[text], salts[text]
            order = np.lexsort((start, doc, seg, key))
            key, seg, doc, mark, salt, start, windows, lead = (
                a[order] for a in (key, seg, doc, mark, salt, start, windows, lead))
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (seg[1:] == seg[:-1])
            head = np.maximum.accumulate(np.where(same, 0, np.arange(len(key)))) if len(key) else np.empty(0, np.int64)
            repeat = same & ((doc != doc[head]) | (start != start[head]))
            key = np.where(repeat, (doc * 0x9E3779B1 + start * 0x85EBCA77).astype(np.int64), key)
            at = _pack(start, salt, windows, lead, repeat.astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (key, seg, doc, mark, at)],
                                              names=["k", "seg", "doc", "mark", "at"])

        for batch in batches:
            docs, marks, salts = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            texts = batch.column(3).to_pylist()
            first = held = 0
            for i, body in enumerate(texts):
                if len(body) >= MAX_TEXT:
                    raise ValueError(f"a text of {len(body)} bytes; the longest that can be compared has {MAX_TEXT - 1}")
                held += len(body)
                if held >= BATCH_BYTES or i == len(texts) - 1:
                    yield found(docs[first:i + 1], marks[first:i + 1], salts[first:i + 1], texts[first:i + 1])
                    first, held = i + 1, 0

    return keyed.filter(F.length("text") >= size).mapInArrow(run, "k bigint, seg bigint, doc bigint, mark bigint, at bigint")


class _Meeting:
    """Streams runs sorted by key, segment, document and place; holds one key's
    representatives only until a second segment shows up."""

    def __init__(self):
        self.k = self.seg = self.doc = self.start = None
        self.segments = 0
        self.held: list[np.ndarray] = []

    def __call__(self, k, seg, doc, mark, at):
        """Rows (k, doc, mark, at, 1) that repeat their segment and (k, doc, mark, at, 0) to compare."""
        start, *_, repeat = _unpack(at)
        marked = repeat == 1
        out = [np.stack([k[marked], doc[marked], mark[marked], at[marked], np.ones(int(marked.sum()), np.int64)], 1)]
        k, seg, doc, mark, at, start = (a[~marked] for a in (k, seg, doc, mark, at, start))
        if not len(k):
            return out[0]
        goes_on = self.k is not None and k[0] == self.k
        new_key = np.ones(len(k), bool)
        new_key[1:] = k[1:] != k[:-1]
        new_key[0] = not goes_on
        new_seg = new_key.copy()
        new_seg[1:] |= seg[1:] != seg[:-1]
        if goes_on:
            new_seg[0] = seg[0] != self.seg
        head = np.maximum.accumulate(np.where(new_seg, np.arange(len(k)), -1))
        h_doc, h_start = doc[head], start[head]
        if not new_seg[0]:
            h_doc, h_start = np.where(head < 0, self.doc, h_doc), np.where(head < 0, self.start, h_start)
        stands = (doc == h_doc) & (start == h_start)
        rows = np.stack([k, doc, mark, at, (~stands).astype(np.int64)], 1)
        out.append(rows[~stands])
        # segments of each key of this batch, counting what came before for the first
        number = np.cumsum(new_key) - (0 if goes_on else 1)
        segments = np.bincount(number, weights=new_seg, minlength=int(number[-1]) + 1).astype(np.int64)
        if goes_on:
            segments[0] += self.segments
            if segments[0] > 1:
                out += self.held
        compared = stands & (segments[number] > 1)
        out.append(rows[compared])
        last = number == number[-1]
        kept = [rows[last & stands]] if segments[-1] < 2 else []
        self.held = (self.held if goes_on and len(segments) == 1 and segments[0] < 2 else []) + kept
        self.k, self.seg, self.segments = int(k[-1]), int(seg[-1]), int(segments[-1])
        self.doc, self.start = int(h_doc[-1]), int(h_start[-1])
        return np.concatenate(out)


def _met(runs: DataFrame) -> DataFrame:
    """(k, doc, mark, at, repeat): runs that repeat an equal run, and runs to compare."""

    def run(batches):
        meeting = _Meeting()
        for batch in batches:
            rows = meeting(*(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(5)],
                                             names=["k", "doc", "mark", "at", "repeat"])

    return runs.repartition("k").sortWithinPartitions("k", "seg", "doc", "at") \
        .mapInArrow(run, "k bigint, doc bigint, mark bigint, at bigint, repeat bigint")


class Columns:
    """Bytes of lined-up segments in an unnamed file, a block of rows after the
    other and column by column within a block."""

    def __init__(self, width: int):
        self.width = width
        self.file = tempfile.TemporaryFile()  # gone with the task, whatever becomes of it
        self.rows = 0
        self.block = np.zeros((width, BLOCK), np.uint8)

    def add(self, left: int, body: bytes) -> None:
        """One segment from column ``left`` on; symbols are bytes plus 1, 0 is none (UTF-8 has no byte 255)."""
        at = self.rows % BLOCK
        self.block[left:left + len(body), at] = np.frombuffer(body, np.uint8) + np.uint8(1)
        self.rows += 1
        if at == BLOCK - 1:
            self._flush()

    def _flush(self) -> None:
        self.file.write(self.block.tobytes())
        self.block[:] = 0

    def close(self) -> None:
        if self.rows % BLOCK:
            self._flush()

    def column(self, x: int) -> np.ndarray:
        out = np.empty(-(-self.rows // BLOCK) * BLOCK, np.uint8)
        for b in range(len(out) // BLOCK):
            self.file.seek((b * self.width + x) * BLOCK)
            out[b * BLOCK:(b + 1) * BLOCK] = np.frombuffer(self.file.read(BLOCK), np.uint8)
        return out[:self.rows]


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high] for each pair, low <= high."""
    table = [values]
    reach = high - low + 1
    level = np.zeros(len(reach), np.int64)
    for bit in range(1, int(reach.max(initial=1)).bit_length()):
        half = 1 << (bit - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        level[reach >= 1 << bit] = bit
    out = np.empty(len(reach), values.dtype)
    for bit, mins in enumerate(table):
        at = np.flatnonzero(level == bit)
        out[at] = np.minimum(mins[low[at]], mins[high[at] - (1 << bit) + 1])
    return out


def repeated_windows(columns: Columns, size: int, windows: np.ndarray, lead: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Bit w of entry i is set if window w of segment i repeats one of lower rank.

    Segment i starts at column ``SPAN - 1 - lead[i]`` and has ``windows[i]``
    windows; ranks order the places of segments, equal places equal.
    """
    columns.close()
    n = columns.rows
    order = np.arange(n)
    common = np.zeros(n, np.uint8)  # prefix that a suffix in order shares with the one before it
    flags = np.zeros(n, np.uint64)
    left = SPAN - 1 - lead
    for x in range(columns.width - 1, -1, -1):
        symbols = columns.column(x)[order]
        by_symbol = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[by_symbol]
        joined = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] > 0)) + 1
        renewed = np.zeros(n, np.uint8)
        if len(joined):
            shared = _range_min(common, by_symbol[joined - 1] + 1, by_symbol[joined])
            renewed[joined] = np.minimum(shared, size - 1) + 1
        order, common = order[by_symbol], renewed
        if x < SPAN:
            window = x - left[order]
            whole = np.flatnonzero((window >= 0) & (window < windows[order]))
            if len(whole):
                own = order[whole]
                # whole windows of one class stand next to each other
                fresh = common[whole] < size
                fresh[0] = True
                heads = np.flatnonzero(fresh)
                lowest = np.minimum.reduceat(rank[own], heads)[np.cumsum(fresh) - 1]
                late = rank[own] > lowest
                flags[own[late]] |= np.uint64(1) << window[whole[late]].astype(np.uint64)
    return flags


def _spans_of(flags: int) -> list[tuple[int, int]]:
    """Maximal ranges of set bits, [first, last]."""
    out, at = [], 0
    while flags >> at:
        if flags >> at & 1:
            first = at
            while flags >> at & 1:
                at += 1
            out.append((first, at - 1))
        else:
            at += 1
    return out


def _compared(segments: DataFrame, size: int) -> DataFrame:
    """(doc, mark, salt, start, stop) of the repeated strings among (k, doc, mark, at, body) rows."""
    width = SPAN - 1 + size  # columns from SPAN - 1 before the anchor to the last window's end

    def run(batches):
        columns, docs, marks, ats = Columns(width), [], [], []
        for batch in batches:
            _, doc, mark, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            lead = _unpack(at)[3]
            for i, body in enumerate(batch.column(4).to_pylist()):
                columns.add(SPAN - 1 - int(lead[i]), body)
            docs.append(doc)
            marks.append(mark)
            ats.append(at)
        if not docs or not columns.rows:
            return
        doc, mark, at = np.concatenate(docs), np.concatenate(marks), np.concatenate(ats)
        start, salt, windows, lead, _ = _unpack(at)
        place = np.lexsort((start + lead, doc))
        step = np.ones(len(place), np.int64)
        step[1:] = (doc[place[1:]] != doc[place[:-1]]) | ((start + lead)[place[1:]] != (start + lead)[place[:-1]])
        rank = np.empty(len(place), np.int64)
        rank[place] = np.cumsum(step)
        flags = repeated_windows(columns, size, windows, lead, rank)
        rows = [(int(doc[i]), int(mark[i]), int(salt[i]), int(start[i]) + a, int(start[i]) + b + size)
                for i in np.flatnonzero(flags) for a, b in _spans_of(int(flags[i]))]
        for first in range(0, len(rows), 10_000):
            part = list(zip(*rows[first:first + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in part],
                                             names=["doc", "mark", "salt", "start", "stop"])

    return segments.repartition("k").mapInArrow(run, "doc bigint, mark bigint, salt bigint, start bigint, stop bigint")


def _segments(keyed: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """(k, doc, mark, at, body) of the runs to compare, cut from their texts."""
    asked = met.filter("repeat = 0").groupBy("doc", "mark", _salt().alias("salt")).agg(
        F.collect_set(F.struct("k", "at")).alias("runs"))  # runs of one text, once for all rows that repeat it

    def cut(batches):
        for batch in batches:
            out = []
            for doc, mark, body, runs in zip(*(c.to_pylist() for c in batch.columns)):
                for r in runs:
                    at = r["at"]
                    first = at >> 33
                    out.append((r["k"], doc, mark, at, body[first:first + (at >> 7 & 63) + size]))
            columns = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["k", "doc", "mark", "at", "body"])

    return keyed.join(asked, ["doc", "mark", "salt"]).select("doc", "mark", "text", "runs") \
        .mapInArrow(cut, "k bigint, doc bigint, mark bigint, at bigint, body binary")


def repeats(keyed: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc, mark, salt, spans): per text of :func:`_keyed` rows with repeats their byte ranges, unmerged.
    ``doc`` is the id (the largest long for NULL), ``mark`` and ``salt`` tell rows of one id apart
    by their text."""
    met = written(_met(_runs(keyed, size)), "met")
    start, windows = F.shiftright("at", 33), F.shiftright("at", 7).bitwiseAND(F.lit(63)) + 1
    known = met.filter("repeat = 1").select("doc", "mark", _salt().alias("salt"), start.alias("start"),
                                            (start + windows + (size - 1)).alias("stop"))
    compared = written(_compared(_segments(keyed, met, size), size), "compared")
    return known.union(compared).groupBy("doc", "mark", "salt").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def kept_bytes(body: bytes, spans: list[list[int]]) -> bytes:
    out, at = [], 0
    for start, stop in spans:
        out.append(body[at:start])
        at = stop
    out.append(body[at:])
    return b"".join(out)


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, the removed ``spans`` (merged byte
    ranges), and ``kept_sha256`` of the bytes that stay."""
    keyed = _keyed(docs, doc_id, text)
    found = repeats(keyed, size)
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = keyed.join(found, ["doc", "mark", "salt"], "left").select("doc", "text", "spans")

    def run(batches):
        for batch in batches:
            out = []
            for doc, body, spans in zip(*(c.to_pylist() for c in batch.columns)):
                cuts = merged([(s["start"], s["stop"]) for s in spans]) if spans else []
                rest = kept_bytes(body, cuts) if cuts else body
                out.append((doc if doc != LAST else None, len(body), len(body) - len(rest), cuts,
                            hashlib.sha256(rest).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])

    out = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<array<bigint>>, "
                               "kept_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast(id_type))
