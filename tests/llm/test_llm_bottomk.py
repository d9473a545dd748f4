import random

import pytest

from cohortkit.llm import bottomk
from cohortkit.llm.components import components

SCHEMA = "doc_id long, text string, kept string"


def brute(rows):
    import re

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(sets[i]), least.get(find(i)), k is None or k == least[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def run(spark, rows):
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], SCHEMA)
    out = bottomk.near_duplicates(df).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)


def edited(rng, words, share):
    return [f"n{rng.random()}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for g in range(8):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 6, 30, 90, 400]))]
        for _ in range(rng.choice([1, 4, 12])):
            words = edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06, 0.1]))
            if rng.random() < 0.3:
                words = words[:len(words) // 2] + passage + words[len(words) // 2:]
            rows.append((len(rows), " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "Ab cd"), (304, "aB\tcd"), (None, "Ab cd"), (None, None),
             (3, rows[3][1]), (305, rows[0][1].upper()), (306, "x " * 3000), (307, "x " * 2500)]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_group_whose_members_differ_from_each_other_more_than_from_the_base(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(140)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.01, 0.02, 0.04, 0.07])))) for i in range(150)] + [(500, " ".join(base))]
    assert run(spark, rows) == brute(rows)


def test_list_of_two_classes_behind_four_more_central_hubs(spark):
    rows = []
    for s in range(12):  # whether the lists of d lead those of a depends on hashes
        a = [f"a{s}.{i}" for i in range(50)]
        b = a[:45] + [f"b{s}.{i}" for i in range(7)]  # 41 of 53 shingles are common
        docs = [a, b, b[41:] + [f"f{s}.{i}" for i in range(20)]]  # the third makes b more central than a
        for d in range(5):
            group = [f"d{s}.{d}.{i}" for i in range(36)]
            docs += [a[41 + d:46 + d] + group] + [group + [f"e{s}.{d}.{e}.{i}" for i in range(4)] for e in range(3)]
        rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate(docs)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_candidates_are_settled_whatever_their_order(spark, rounds):
    """A misleading ``apart`` puts unlinked pairs first; every link between components must still count."""
    rng = random.Random(rounds)
    texts = []
    for g in range(12):
        base = [f"g{g % 4}.{i}" for i in range(120)]
        texts += [" ".join(edited(rng, base, rng.choice([0.01, 0.015, 0.04]))) for _ in range(4)]
    texts = sorted(set(texts))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    found = bottomk.classes(bottomk.sketches(docs))
    body = bottomk.texts_of(found, found, docs)
    nodes = {r.doc_id: r.node for r in found.collect()}
    first = sorted(nodes.values())[:3]  # one component is known before
    ends = [sorted((nodes[i], nodes[j])) for i in range(len(texts)) for j in range(i) if rng.random() < 0.6]
    of = [(u, v, *sorted(first[0] if n in first else n for n in (u, v))) for u, v in ends]
    pairs = [(u, v, rng.randrange(5), lo, hi) for u, v, lo, hi in of if lo != hi]
    some = spark.createDataFrame(pairs, "u long, v long, apart long, lo long, hi long")
    known = spark.createDataFrame([(n, first[0]) for n in first], "node long, root long")
    links, roots = bottomk.settled(some, known, body, rounds=rounds)
    every = bottomk.verified(some.select("u", "v"), body)
    assert every.count() > links.count() or rounds == 0
    assert {tuple(r) for r in links.collect()} <= {tuple(r) for r in every.collect()}
    wanted = components(every.union(known.select("node", "root")))
    assert sorted(map(tuple, roots.collect())) == sorted(map(tuple, wanted.collect()))
    none, same = bottomk.settled(some.limit(0), known, body, rounds=rounds)
    assert none is None and sorted(map(tuple, same.collect())) == sorted(map(tuple, known.collect()))


def test_chain_of_links(spark):
    words = [f"c{i}" for i in range(160)]
    rows = [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(20)]
    assert run(spark, rows) == brute(rows)


def test_empty_and_keep_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bottomk.near_duplicates(empty).count() == 0
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text, "a"), (2, text + " more", "b"), (2, text + " more", "b"), (7, "other", "c"), (None, text, "d"), (9, None, "e")]
    got = sorted((tuple(r) for r in bottomk.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == sorted([rows[1], rows[3], rows[4], rows[5]], key=repr)


def test_keep_one_tells_rows_of_one_id_apart(spark):
    text = " ".join(f"t{i}" for i in range(30))
    other = " ".join(f"o{i}" for i in range(30))
    rows = [(1, text, "a"), (2, text + " tail", "b"), (2, other, "c"), (3, other + " x", "d"), (3, other + " y", "e"),
            (4, None, "f"), (4, None, "g"), (5, "ü" * 300_000, "h"), (6, "w " * 200_000, "i"), (None, None, "j")]
    df = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("kept", "component")
    got = sorted((tuple(r) for r in bottomk.keep_one(df).collect()), key=repr)
    assert got == sorted([rows[0], rows[2], *rows[5:]], key=repr)
    # two near copies under the smallest id of their component: one of them stays
    twice = [(1, text, "a"), (1, text + " tail", "b"), (1, other, "c"), (2, text, "d")]
    got = [tuple(r) for r in bottomk.keep_one(spark.createDataFrame(twice, SCHEMA)).collect()]
    assert len(got) == 2 and twice[2] in got and (twice[0] in got or twice[1] in got)


def test_many_texts_under_one_id_come_once_each(spark):
    texts = [" ".join(f"w{t}.{i}" for i in range(12)) for t in range(1000)]
    df = spark.createDataFrame([(7, t, "x") for t in texts] + [(7, texts[0], "y")] * 50, SCHEMA)
    found = bottomk.classes(bottomk.sketches(df))
    assert found.count() == 1000
    assert bottomk.texts_of(found, found, df).count() == 1000


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for u, v in pairs:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    assert got == {i: find(i) for i in root}
