"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items form one generalised suffix automaton
per bounded block of items.  Training documents are streamed through it word
by word; the automaton's state and matched length give, at every word, the
longest suffix that occurs in some item.  Where it reaches a window (ten
words, or a whole item that is shorter) the words below it are hit.

Sizes: an automaton is built for at most ``block_words`` words of items,
whatever the size of the benchmark.  Items are numbered by running word sums and
cut into blocks by tasks (an item longer than half a block into pieces that
share ``window - 1`` words), which also build and write the automata; the driver
hands on one at a time.  A longer benchmark takes one pass over the documents
per block, with a written table between passes.  Documents are never shuffled.

Defined results: a NULL or wordless text has no words and no hits; an item
without words gives no window; an item with a NULL id marks words but is not
listed; repeated items are listed once; repeated documents are judged one by
one; other columns pass through untouched.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import arrow_schema, worker_state, written

WINDOW = 10
BLOCK_WORDS = 250_000
NEVER = 1 << 60

# lower case A-Z; every ASCII byte that is no letter or digit separates words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else (b if b >= 128 or chr(b).isalnum() else 32) for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | str | None) -> list[bytes]:
    if text is None:
        return []
    raw = text.encode() if isinstance(text, str) else bytes(text)
    return raw.translate(_FOLD).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences.

    ``step[s]`` maps a word to the next state, ``link`` and ``longest`` are
    the suffix links and longest lengths.  ``need[s]`` is the matched length
    from which state ``s`` ends a window.
    """

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.longest = [0]
        kept = [(key, words) for key, words in items if words]
        ends = [self._add(words) for _, words in kept]
        self._mark(kept, ends)

    def _state(self, longest: int, step: dict[bytes, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state for ``p``'s strings plus ``word`` where ``q`` also holds longer ones."""
        if self.longest[q] == self.longest[p] + 1:
            return q
        part = self._state(self.longest[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = part
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = part
            p = self.link[p]
        return part

    def _add(self, words: list[bytes]) -> int:
        last = 0
        for word in words:
            known = self.step[last].get(word)
            if known is not None:
                last = self._split(last, known, word)
                continue
            new = self._state(self.longest[last] + 1, {}, 0)
            p = last
            while p >= 0 and word not in self.step[p]:
                self.step[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.step[p][word], word)
            last = new
        return last

    def _mark(self, kept: list[tuple[object, list[bytes]]], ends: list[int]) -> None:
        window, link, longest, step = self.window, self.link, self.longest, self.step
        owners: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, object]]] = {}
        seen: dict[int, int] = {}
        for number, (key, words) in enumerate(kept):
            if len(words) < window:
                self.short.setdefault(self._walk(words), []).append((len(words), key))
                continue
            state = 0
            for word in words:
                state = step[state][word]
                up = state
                while up > 0 and longest[up] >= window and seen.get(up) != number:
                    seen[up] = number
                    owners.setdefault(up, set()).add(key)
                    up = link[up]
        order = sorted(range(len(link)), key=longest.__getitem__)
        self.holder = [-1] * len(link)  # the state on the link path whose strings include the last window
        self.above = [-1] * len(link)  # nearest state on the link path where a short item ends
        self.need = [NEVER] * len(link)
        for s in order[1:]:
            up = link[s]
            if longest[s] >= window:
                self.holder[s] = s if longest[up] < window else self.holder[up]
                self.need[s] = window
            self.above[s] = up if up in self.short else self.above[up]
            if s in self.short:
                self.need[s] = min(self.need[s], min(n for n, _ in self.short[s]))
            if self.above[s] >= 0:
                self.need[s] = 0
        held = set(self.holder)
        self.owners = {s: frozenset(k for k in keys if k is not None) for s, keys in owners.items() if s in held}

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for word in words:
            state = self.step[state][word]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Hit word ranges [start, end) in order, merged, and the items that occur."""
        step, link, longest, need = self.step, self.link, self.longest, self.need
        state = matched = 0
        spans: list[list[int]] = []
        items: set = set()
        for at, word in enumerate(words):
            to = step[state].get(word)
            if to is not None:
                matched += 1
            elif state == 0:
                continue
            else:
                while to is None and state:
                    state = link[state]
                    to = step[state].get(word)
                if to is None:
                    matched = 0
                    continue
                matched = longest[state] + 1
            state = to
            if matched >= need[state]:
                self._hit(state, matched, at + 1, spans, items)
        return spans, items

    def _hit(self, state: int, matched: int, end: int, spans: list[list[int]], items: set) -> None:
        width = 0
        if matched >= self.window:
            width = self.window
            items |= self.owners[self.holder[state]]
        at = state if state in self.short else self.above[state]
        while at >= 0:
            for size, key in self.short[at]:
                if size <= matched:
                    width = max(width, size)
                    if key is not None:
                        items.add(key)
            at = self.above[at]
        start = end - width
        while spans and spans[-1][0] >= start:
            spans.pop()
        if spans and spans[-1][1] >= start:
            spans[-1][1] = end
        else:
            spans.append([start, end])


def merge_spans(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _pieces(benchmark: DataFrame, item_id: str, text: str, window: int, most: int) -> DataFrame:
    """(k, n, t): the items' normalised words, cut into pieces of at most ``most`` words;
    every window lies within a piece."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(value)
                starts = range(0, max(1, len(words) - window + 1), most - window + 1) if len(words) > most else (0,)
                rows += [(key, part) for part in (words[at:at + most] for at in starts) if part]
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in rows], pa.string()), pa.array([len(w) for _, w in rows], pa.int64()),
                pa.array([b" ".join(w) for _, w in rows], pa.binary())], names=["k", "n", "t"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("k"), F.col(text).cast("binary").alias("t"))
    return rows.mapInArrow(run, "k string, n long, t binary")


def automata(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """(block, words, automaton): one pickled automaton per block of at most ``block_words`` words."""
    most = max(2 * window, block_words // 2)  # a piece starts within its block and may end in the next
    pieces = written(_pieces(benchmark, item_id, text, window, most), "benchmark-pieces")
    placed = pieces.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = placed.groupBy("file").agg(F.sum("n").alias("n")).select(
        "file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.withColumn("own", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(files, "file") \
        .select("k", "t", F.floor((F.col("base") + F.col("own")) / most).alias("block"))

    def build(key, group):
        items = [(k, t.split()) for k, t in zip(group["k"].to_pylist(), group["t"].to_pylist())]
        made = pickle.dumps(SuffixAutomaton(items, window), pickle.HIGHEST_PROTOCOL)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "words": pa.array([sum(len(w) for _, w in items)], pa.int64()),
                         "automaton": pa.array([made], pa.binary())})

    return written(blocks.groupBy("block").applyInArrow(build, "block long, words long, automaton binary"),
                   "benchmark-automata")


SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` plus ``__ck_words`` (count), ``__ck_spans`` (hit word ranges) and ``__ck_items``
    (ids of occurring items, sorted as strings)."""
    fields = docs.schema.fields
    schema = T.StructType([*fields, T.StructField("__ck_words", T.LongType()), T.StructField("__ck_spans", SPANS),
                           T.StructField("__ck_items", T.ArrayType(T.StringType()))])
    out = arrow_schema(schema)
    at = docs.columns.index(text)
    width = len(fields)
    sc = docs.sparkSession.sparkContext

    def one_pass(df: DataFrame, automaton) -> DataFrame:
        shared = sc.broadcast(automaton)
        first = len(df.columns) == width

        def run(batches):
            worker_state("rows", dict)
            machine = shared.value
            for batch in batches:
                counts, spans, items = [], [], []
                for row, value in enumerate(batch.column(at)):
                    words = words_of(value.as_py())
                    found, keys = machine.scan(words) if machine is not None else ([], set())
                    if not first:
                        found = merge_spans(batch.column(width + 1)[row].as_py(), found)
                        keys = keys.union(batch.column(width + 2)[row].as_py())
                    counts.append(len(words))
                    spans.append(found)
                    items.append(sorted(keys))
                made = [pa.array(v, f.type) for v, f in zip((counts, spans, items), list(out)[width:])]
                kept = [c if c.type == f.type else c.cast(f.type) for c, f in zip(batch.columns[:width], out)]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema=out)

        return df.mapInArrow(run, schema)

    df, last = docs, None
    built = automata(benchmark, item_id, item_text, window, block_words)
    for row in built.select("block").orderBy("block").collect():
        if last is not None:
            df = written(one_pass(df, last), "decontaminate-pass")
        last = pickle.loads(built.filter(F.col("block") == row.block).select("automaton").first().automaton)
    return one_pass(df, last)


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, occurring items and the hit word ranges."""
    found = scan(docs.select(doc_id, F.col(text).cast("binary").alias("_text")), benchmark, "_text", window=window)
    return found.select(
        doc_id,
        F.col("__ck_words").alias("n_words"),
        F.aggregate("__ck_spans", F.lit(0).cast("long"), lambda acc, s: acc + (s[1] - s[0])).alias("n_hit"),
        F.size("__ck_items").cast("long").alias("n_items"),
        F.col("__ck_items").alias("items"),
        F.col("__ck_spans").alias("spans"),
    )


def cut_spans(text: bytes, spans: list[list[int]]) -> bytes:
    """``text`` without the words of ``spans`` (and what stands between those words)."""
    places = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:places[start][0]])
        at = places[end - 1][1]
    out.append(text[at:])
    return b"".join(out)


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
           min_span: int = 1, max_coverage: float = 0.8) -> DataFrame:
    """``docs`` with contaminated spans of at least ``min_span`` words cut out of
    the text; a document whose hit words exceed ``max_coverage`` of its words
    goes as a whole.  Clean rows come back unchanged."""
    found = scan(docs, benchmark, text, window=window)
    hit = F.aggregate("__ck_spans", F.lit(0).cast("long"), lambda acc, s: acc + (s[1] - s[0]))
    found = found.filter(~(hit > F.col("__ck_words") * F.lit(max_coverage)))
    schema = docs.schema
    out = arrow_schema(schema)
    at, width = docs.columns.index(text), len(docs.columns)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for row, spans in enumerate(batch.column(width + 1)):
                cut = [s for s in spans.as_py() if s[1] - s[0] >= min_span]
                if cut:
                    texts[row] = cut_spans(texts[row].encode(), cut).decode()
            columns = [pa.array(texts, out.field(i).type) if i == at else c for i, c in enumerate(batch.columns[:width])]
            yield pa.RecordBatch.from_arrays(
                [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return found.mapInArrow(run, schema)
