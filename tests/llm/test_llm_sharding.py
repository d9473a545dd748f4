"""Differencing against known partitions and a greedy bound; every row placed once, equal texts together."""

import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortkit.llm import sharding
from cohortkit.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, shard string, n long, item long"


def _sums(sizes, lane, k):
    return np.bincount(lane, weights=sizes, minlength=k)


def _by_hand(sizes, k):
    """Differencing as it is told: tuples of all k lanes, the two of largest spread combined."""
    parts = [(sorted([s] + [0] * (k - 1), reverse=True)) for s in sorted(sizes, reverse=True)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0] - p[-1], reverse=True)
        a, b = parts[0], parts[1]
        parts = parts[2:] + [sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)]
    return parts[0][0] - parts[0][-1]


def test_the_textbook_example():
    assert np.ptp(_sums([8, 7, 6, 5, 4], sharding.difference(np.array([8, 7, 6, 5, 4]), 2), 2)) == 2
    assert np.ptp(_sums([4, 5, 6, 7, 8], sharding.difference(np.array([4, 5, 6, 7, 8]), 3), 3)) <= 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=40, unique=True), st.integers(2, 7))
def test_the_spread_is_that_of_full_tuples(sizes, k):
    lane = sharding.difference(np.array(sizes), k)
    assert len(lane) == len(sizes) and lane.min() >= 0 and lane.max() < k
    assert np.ptp(_sums(sizes, lane, k)) == _by_hand(sizes, k)


def test_closer_than_greedy():
    sizes = np.random.default_rng(5).integers(100, 50_000, 4000)
    greedy = np.zeros(40)
    for s in sorted(sizes, reverse=True):
        greedy[greedy.argmin()] += s
    assert np.ptp(_sums(sizes, sharding.difference(sizes, 40), 40)) < np.ptp(greedy) / 10


def test_giants_get_a_shard_alone():
    sizes = np.array([10**6, 10**5, *[100] * 3900])
    sums = _sums(sizes, sharding.partition(sizes, 41), 41)
    assert sums[0] == 10**6 and sums[1] == 10**5 and set(sums[2:]) == {10_000.0}


def _check(rows, texts, shards):
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in texts)
    of_text, slots, size = defaultdict(set), defaultdict(list), Counter()
    text_of = dict(texts)
    for r in rows:
        text = (text_of[r.doc_id] or "").encode()
        assert r.size == len(text) + 16 and r.text_crc32 == zlib.crc32(text)
        of_text[text].add(r.shard)
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return [size[i] for i in range(shards)]


def test_edges(spark):
    texts = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "ü" * 50_000), (6, "b c"), (7, None), (8, "b c")]
    docs = spark.createDataFrame([(d, t, "x", 9, 9) for d, t in texts], SCHEMA)
    size = _check(sharding.assign(docs, 5).collect(), texts, 5)
    assert sorted(size) == [0, 34, 38, 48, 100_016] and size[0] == 100_016
    twice = sharding.assign(docs.union(docs).withColumn("doc_id", docs.doc_id * 0), 3).collect()
    assert len(twice) == 16 and {r.doc_id for r in twice} == {0}
    none = spark.createDataFrame([(None, "a", None, None, None)], SCHEMA)
    assert [(r.doc_id, r.shard, r.slot) for r in sharding.assign(none).collect()] == [(None, 0, 0)]
    assert sharding.assign(docs.where("false")).count() == 0
    carried = sharding.assign(docs, 2, carry=("doc_id", "n", "item")).first()
    assert (carried.n, carried.item) == (9, 9)


def test_rounds_of_bundles(spark, monkeypatch):
    # small bounds: two rounds of blocks before the last one
    for name, value in (("BLOCK", 100), ("LAST", 400), ("SINGLES", 200), ("FAN_IN", 4)):
        monkeypatch.setattr(sharding, name, value)
    rng = np.random.default_rng(3)
    texts = [(i, "x" * int(n) + str(i)) for i, n in enumerate(rng.integers(1, 3000, 4000))]
    texts += [(10_000 + i, "copy " * 40) for i in range(3000)]  # 648,000 bytes: a third of all rows
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    size = _check(sharding.assign(docs, 12).collect(), texts, 12)
    # the copies stand alone (fair share 577,000), the others differ by less than a hundredth
    assert size[0] == 216 * 3000 and np.ptp(size[1:]) < max(size[1:]) / 100


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i % 7}", "x") for i in range(50)], "doc_id long, text string, extra string")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 50 and back.groupBy("text").agg({"__ck_shard": "count"}).count() == 7
    assert back.select("text", "__ck_shard").distinct().count() == 7


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
def test_the_query_on_whole_tables(spark):
    rows = queries()["op11_sharding"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    size = _check(rows, [(d.doc_id, d.text) for d in docs], 40)
    biggest = Counter()
    for d in docs:
        biggest[d.text] += len((d.text or "").encode()) + 16
    # no more above the mean than one group explains
    assert max(size) <= sum(size) / 40 + max(biggest.values())
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
