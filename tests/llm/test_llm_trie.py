"""The trie against one built by hand from whole sequences."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cohortkit.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string, depth long, rep long, n string"


def by_hand(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tag = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[c].append(((turn is not None, turn or 0, tag), (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        start = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(start, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = Counter(), Counter()
    for s in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        leaves[s] += not kids[s]
        saved[s] += (len(members[s]) - 1) * words
        if s:
            leaves[s[:-1]] += leaves[s]
            saved[s[:-1]] += saved[s]
    out = []
    for s, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(built[c]) == len(s)))
        out.append((min(cs), len(s), min(members[s[:-1]]) if s else None, len(cs), len(kids[s]), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def _run(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    return Counter(tuple(r) for r in trie.trie(frame, **kw).collect())


def _random_rows(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-30, 200), n):
        for t in range(rnd.randrange(1, 9)):
            rows.append((c, t, rnd.choice(["user", "bot"]), rnd.choice(["hi", "go on", "what is it", ""])))
    return rows


def test_shared_and_absent_starts(spark):
    rows = _random_rows(1)
    assert _run(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("band", [2, 3])
def test_long_conversations_over_many_bands_and_slices(spark, monkeypatch, band):
    monkeypatch.setattr(trie, "SLICE", 16)
    monkeypatch.setattr(trie, "CHUNK_BITS", 1)
    rnd = random.Random(band)
    rows = _random_rows(2, 40)
    long = [(t, "user" if t % 2 else "bot", f"turn {t}") for t in range(90)]
    for c in range(1000, 1012):  # one family; they part at different depths, some are copies
        cut = rnd.choice([5, 40, 77, 90])
        rows += [(c, *t) for t in long[:cut]] + [(c, 100 + i, "user", f"own {c % 3} {i}") for i in range(rnd.randrange(0, 40))]
    rnd.shuffle(rows)
    assert _run(spark, rows, band=band) == by_hand(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(7, None, "user", "first"), (7, None, None, "first"), (7, 1, "user", None), (7, 1, None, None), (7, 1, "a", "b c"),
            (7, 1, "ab", " c"), (7, 1, "a", "b c"), (None, 1, "user", "x"), (None, None, None, None),
            (8, 3, "user", "w " * 100_000), (28, 3, "user", "w " * 100_000), (9, 1, "u", "only")]
    rows += [(c, 0, "user", "same start") for c in range(400, 700)]  # one group of copies
    assert _run(spark, rows) == by_hand(rows)


def test_an_empty_table(spark):
    found = trie.trie(spark.createDataFrame([], SCHEMA))
    assert found.collect() == []
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"]
