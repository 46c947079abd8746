import hashlib

import brute
import numpy as np
import pytest
from growthlake.llm import merkle
from growthlake.llm.common import ranked, table

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def answers(rows):
    return sorted(([*map(str, r)] for r in rows))


def of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_states_are_those_of_sha256():
    text = [bytes(range(k, k + 32)) for k in range(5)]
    words = np.array([np.frombuffer(t, ">u4") for t in text]).T.astype(np.uint32)
    state = merkle.compress(np.repeat(merkle.START, 5, axis=1), merkle.hex_block(words))
    got = merkle.finish(state, np.ones(5, np.int64)).T.astype(">u4")
    assert [x.tobytes() for x in got] == [hashlib.sha256(t.hex().encode()).digest() for t in text]
    empty = merkle.finish(merkle.START, np.zeros(1, np.int64)).T.astype(">u4").tobytes()
    assert empty == hashlib.sha256(b"").digest()


def test_odd_rows(odd, odd_rows):
    got = merkle.document_manifest(odd)
    assert got.columns == COLUMNS
    assert answers(got.collect()) == answers(brute.merkle([(r[0], r[3], r[2], r[4], r[1]) for r in odd_rows]))


def test_empty(empty):
    assert merkle.document_manifest(empty).collect() == []


@pytest.mark.parametrize("levels", [1, 2])
def test_many_rounds_give_the_tree_of_one(spark, monkeypatch, levels):
    """Blocks of 3 or 9 nodes need several rounds where the usual size needs one."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3 ** levels)
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert answers(merkle.document_manifest(docs).collect()) == answers(brute.merkle(of(docs)))


def test_folding_needs_no_left_sibling(spark):
    """With the left siblings of every step wiped, a replaced leaf still gives its root."""
    digest = np.array([np.frombuffer(hashlib.sha256(b"%d" % i).digest(), ">u4") for i in range(9)]).T.astype(np.uint32)
    path, top = merkle.climb(np.arange(9), np.full(9, 2), digest)
    for step in path:
        for i in range(9):
            step["others"][i, :step["slot"][i]] = 0
    root, _ = merkle.fold(digest, path)
    assert (root == top).all()


def test_places_across_ranges(spark):
    rows = [(g, i) for g, n in ((None, 5), ("a", 700), ("b", 1), ("c", 90)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long").repartition(7)
    got = ranked(df, ["g"], ["i"], "place").collect()
    assert len(got) == len(rows) and all(r.i == r.place for r in got)
    alike = ranked(spark.createDataFrame([("a", 1)] * 500, "g string, i long"), ["g"], ["i"], "place").collect()
    assert sorted(r.place for r in alike) == list(range(500))


def test_query(spark):
    from growthlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = QUERIES["op12_merkle_manifest"](spark, sf).select(*COLUMNS).collect()
    assert answers(got) == answers(brute.merkle(of(table(spark, sf, "documents"))))
