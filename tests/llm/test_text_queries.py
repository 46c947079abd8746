"""The registered text queries: against SQL where there is some, else against brute force over whole tables."""

from collections import Counter

import brute
import corpus_pipeline
import pytest
from compare import differences, duck_connection
from growthlake.llm.common import table
from growthlake.llm.oracle import ORACLE
from growthlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck_connection(SF), ORACLE[name]) is None


def test_simhash_query(spark, documents):
    prints = [brute.fingerprint(t) for _, t in documents]
    near = brute.classes([d for d, _ in documents], lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 4)
    got = QUERIES["op1_simhash_near_dedup"](spark, SF).collect()
    assert {tuple(r) for r in got} == {(d, f"{p:016x}", c) for (d, _), p, c in zip(documents, prints, near)}


def test_personal_data_query(spark, documents):
    texts = dict(documents)
    for r in QUERIES["op7_personal_data"](spark, SF).collect():
        assert r.base_sha256 == brute.sha(",".join(brute.base_spans(texts[r.doc_id])))


def test_quality_query(spark, documents):
    texts = dict(documents)
    for r in QUERIES["op6_quality_rules"](spark, SF).collect():
        assert (r.n_words, r.n_repeat_words, r.n_dup_lines) == (
            len(brute.words(texts[r.doc_id])), brute.repeat_words(texts[r.doc_id]), brute.duplicate_lines(texts[r.doc_id]))


def test_mixing_query(spark, documents):
    got = QUERIES["op4_mixing"](spark, SF).collect()
    assert len(got) == len(documents) and all(r.taken <= 3 * r.size for r in got)
    assert sum(r.taken for r in got) == pytest.approx(sum(r.size for r in got), rel=0.02)


def test_secret_query(spark, documents):
    texts = dict(documents)
    for r in QUERIES["op3_secret_scan"](spark, SF).collect():
        assert brute.sha(texts[r.doc_id][r.start:r.end]) == r.value_sha256


def test_pipeline_stages(spark, documents):
    """Each stage keeps columns and rows of its input, leaves one of each group of copies, and no benchmark passage."""
    docs = table(spark, SF, "documents")
    texts = dict(documents)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF).cache()
        assert docs.columns == before.columns
        assert all(texts[r.doc_id] == r.text for r in docs.collect())
        if name == "near_dedup":
            assert max(Counter(r.text for r in docs.collect()).values()) == 1
    assert [tuple(r) for r in docs.limit(0).collect()] == []


def test_pipeline_runs(spark):
    got = sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: r.start)
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
