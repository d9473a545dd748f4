"""The pipeline on the driver's smallest tables, stage by stage against plain Python."""

import os
import re

import pytest

import corpus_pipeline as P
from cohortkit.llm.common import table, written
from test_llm_bottomk import brute as near_brute
from test_llm_decontaminate import brute as leak_brute

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SMALL, "documents")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(written(stage(spark, out[-1], SMALL), "test"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "MinHash near-dedup", "benchmark decontamination", "PII", "best-fit packing"]
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_near_dedup_keeps_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert ids(stages[2]) == sorted(k for k, _, _, kept in near_brute(rows) if kept)


def test_no_benchmark_passage_is_left(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    before = {k: hit for k, _, hit, _, _ in leak_brute([(r.doc_id, r.text) for r in stages[2].collect()], items)}
    after = [(r.doc_id, r.text) for r in stages[3].collect()]
    assert not any(hit for _, _, hit, _, _ in leak_brute(after, items))
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    assert all(t == texts[k] for k, t in after if not before[k])
    assert {k for k, hit in before.items() if not hit} <= {k for k, _ in after}


def test_private_data_is_replaced(stages):
    sign = re.compile(r"\S+@\S+\.\w+|\b\d{16}\b|\b\d+\.\d+\.\d+\.\d+\b|\(\d{3}\) \d{3}-\d{4}")
    before = {r.doc_id: r.text for r in stages[3].collect()}
    after = {r.doc_id: r.text for r in stages[4].collect()}
    assert before.keys() == after.keys()
    for k, text in before.items():
        assert all(found not in after[k] for found in sign.findall(text))
        if not sign.search(text) and "token" not in text:
            assert after[k] == text


def test_packed_pieces_cover_every_document(stages):
    out = stages[5].collect()
    assert {r.doc_id for r in out} == set(ids(stages[4]))
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def test_toxic_stage_takes_rejected_rows_only(spark, stages):
    from cohortkit.llm import toxicity

    model = toxicity.train(stages[0], table(spark, SMALL, "labels"))
    kept = [r.doc_id for r in toxicity.score(stages[0], model, name="s").collect() if r.s < 0.5]
    assert ids(stages[1]) == sorted(kept)
