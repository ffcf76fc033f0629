"""The pipeline, stage by stage against plain versions, each on what its predecessor kept."""

import collections

import plain
import pytest
from test_operators import check_copies, check_mix, check_packing  # noqa: F401

import corpus_pipeline
from siftgate.llm import common, simhash, toxicity

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before each stage and after the last."""
    docs = common.table(spark, SF_DIR, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def test_toxic_documents_go(spark, stages):
    docs = common.table(spark, SF_DIR, "documents")
    scored = toxicity.score_documents(docs, common.table(spark, SF_DIR, "labels"), [docs["doc_id"]])
    bad = {r.doc_id for r in scored.collect() if r.score >= toxicity.REJECT}
    assert 0 < len(bad) < 0.2 * len(stages[0])
    assert sorted(stages[1]) == sorted(r for r in stages[0] if r.doc_id not in bad)


def test_copies_go(stages):
    last = {}
    for r in stages[1]:
        if r.text not in last or r.doc_id > last[r.text].doc_id:
            last[r.text] = r
    assert sorted(stages[2]) == sorted(last.values())


def test_near_copies_go(stages):
    rows = sorted(stages[2])
    parts = plain.roots([plain.fingerprint(r.text) for r in rows], simhash.DISTANCE)
    assert sorted(stages[3]) == [r for i, r in enumerate(rows) if parts[i] == i]
    assert len(stages[3]) < len(stages[2])


def test_mix_keeps_targets(stages):
    sizes, longest, taken = collections.Counter(), collections.Counter(), collections.Counter()
    for r in stages[3]:
        n = len(plain.WORD.findall(r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in stages[4]:
        taken[r.source] += len(plain.WORD.findall(r.text))
    for source, target in plain.targets(sizes).items():
        assert abs(taken[source] - target) <= longest[source] / 2 + 1e-6
    copies = collections.Counter(r.doc_id for r in stages[4])
    assert max(copies.values()) <= 3 and set(stages[4]) <= set(stages[3])


def test_pieces_hold_all_tokens(stages):
    check_packing([(r.doc_id, r.text) for r in stages[4]], stages[5])


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    key = ("doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")
    assert sorted(tuple(r[k] for k in key) for r in found.collect()) == sorted(tuple(r[k] for k in key) for r in stages[5])
