import random

import brute
import numpy as np
import pytest
from growthlake.llm import trie
from growthlake.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string, a long, depth int, place string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(seed, n, turns, words=2, hot=0):
    """Few words and roles, so conversations share prefixes; nulls, ties, negative turns and repeated rows."""
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        if draw.random() < 0.1:
            continue
        rows += [(c * draw.choice([1, 1, 3]), draw.choice([None, k, k, k, -k, 1]), draw.choice(["u", "a", None]),
                  draw.choice(["é" * draw.randrange(1, words + 1), "", None, "x"])) for k in range(draw.randrange(turns))]
    rows += [(200, k, "u", "x") for k in range(hot)]
    rows += [(None, 1, "u", "lost"), *rows[:3]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "p") for r in rows], SCHEMA).repartition(3)


def answers(rows):
    return sorted(map(str, map(tuple, rows)))


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (2, 5000)).astype(np.uint64)
    keys[0, :50] = keys[0, 0]
    table = trie.PerfectHash(*keys[:, :4000])
    assert sorted(table.find(*keys[:, :4000]).tolist()) == list(range(4000))
    assert (table.find(*keys[:, 4000:]) == -1).all()
    with pytest.raises(ValueError):
        trie.PerfectHash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_conversations(spark, seed):
    rows = conversations(seed, 260, 9)
    got = trie.prefix_trie(frame(spark, rows))
    assert got.columns == COLUMNS
    assert answers(got.collect()) == answers(brute.prefix_trie(rows))


def test_long_conversations_are_several_runs_and_segments(spark, monkeypatch):
    """Tiny bounds: a hot conversation is many runs, its chain many segments, the trie many shards."""
    for bound, value in (("RUN", 4), ("SEGMENT", 5), ("SHARD", 16)):
        monkeypatch.setattr(trie, bound, value)
    rows = conversations(3, 120, 8, hot=70)
    # chains that hang from one another, one turn longer each
    rows += [(1000 + 100 * k, t, "u", "x") for k in range(12) for t in range(3 + k)]
    assert answers(trie.prefix_trie(frame(spark, rows)).collect()) == answers(brute.prefix_trie(rows))


def test_clashing_digests_are_built_anew(spark, monkeypatch):
    """Digests that don't tell prefixes apart are noticed, and another salt is taken."""
    real, salts = trie.rebuilt, []

    def weak(conversations, salt):
        salts.append(salt)
        convs, members = real(conversations, salt)
        return (convs, members.withColumn("a", members["a"] * 0 + 1).withColumn("b", members["b"] * 0)) if salt == 0 \
            else (convs, members)

    monkeypatch.setattr(trie, "rebuilt", weak)
    rows = conversations(4, 20, 5)
    assert answers(trie.prefix_trie(frame(spark, rows)).collect()) == answers(brute.prefix_trie(rows))
    assert salts == [0, 1]


def test_empty(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    from growthlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, sf).select(*COLUMNS).collect()
    assert answers(got) == answers(brute.prefix_trie(rows))
