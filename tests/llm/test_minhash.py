import math
import random

import brute
import numpy as np
import pytest
from growthlake.llm import minhash
from growthlake.llm.common import table

COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def answers(rows):
    return sorted(map(str, map(tuple, rows)))


def near_copies(seed, groups, size, words=120):
    """Groups of texts that differ in a few words from one another, about the limit; some share a long passage."""
    draw = random.Random(seed)
    out = []
    for g in range(groups):
        base = brute.prose(seed * 1000 + g, words + 30 * (g % 3)).split()
        if g % 4 == 0:
            base[:40] = brute.prose(seed, 40).split()
        for _ in range(size):
            copy = list(base)
            for _ in range(draw.randrange(0, len(base) // 8 + 1)):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(10**6)}"
            out.append(" ".join(copy[draw.randrange(2):]))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_odd_rows(odd, odd_rows):
    got = minhash.near_duplicate_sets(odd)
    assert got.columns == COLUMNS
    assert answers(got.collect()) == answers(brute.similar_sets([(r[0], r[1]) for r in odd_rows]))


def test_empty(empty):
    assert minhash.near_duplicate_sets(empty).collect() == []


def test_near_copies(spark):
    """Sets of all sizes about those at which lists and sketches are cut."""
    texts = [t for words in (4, 20, 40, 120) for t in near_copies(words, 30, 6, words)]
    assert answers(minhash.near_duplicate_sets(frame(spark, texts)).collect()) == answers(
        brute.similar_sets(list(enumerate(texts))))


def test_large_groups_use_the_long_lists(spark, monkeypatch):
    """With short lists called frequent, stars and pairs across components find the same."""
    monkeypatch.setattr(minhash, "OFTEN", 4)
    texts = near_copies(7, 3, 60) + near_copies(8, 2, 40, 12) + ["one very common line"] * 30
    assert answers(minhash.near_duplicate_sets(frame(spark, texts)).collect()) == answers(
        brute.similar_sets(list(enumerate(texts))))


def test_copies_not_near_enough_are_ruled_out_by_parts(spark, monkeypatch):
    """Copies that lack different words of one text, too many for a link, are not compared with all others."""
    compared = []
    by_sketch = minhash.by_sketch
    monkeypatch.setattr(minhash, "OFTEN", 4)
    monkeypatch.setattr(minhash, "by_sketch", lambda pairs, *more: compared.append(pairs.count()) or by_sketch(pairs, *more))
    draw = random.Random(3)
    base = brute.prose(31, 400).split()[:300]
    texts = []
    for edits in [6] * 40 + [15] * 40:
        copy = list(base)
        for place in draw.sample(range(1, 299, 2), edits):
            copy[place] = f"w{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    assert answers(minhash.near_duplicate_sets(frame(spark, texts)).collect()) == answers(
        brute.similar_sets(list(enumerate(texts))))
    # the last are pairs across components
    assert compared[-1] < 500


def test_texts_with_two_fifths_in_common_are_listed_once(spark, monkeypatch):
    """A passage in more texts than a short list has makes none of them meet again by more values."""
    left = []
    meetings = minhash._meetings

    def counted(*args, **more):
        out = meetings(*args, **more)
        left.append(out[1].select("id").distinct().count())
        return out

    monkeypatch.setattr(minhash, "_meetings", counted)
    passage = brute.prose(41, 400).split()[:240]
    texts = [" ".join(passage + [f"w{t}x{k}" for k in range(400)]) for t in range(minhash.OFTEN + 8)]
    got = minhash.near_duplicate_sets(frame(spark, texts)).collect()
    assert all(r["kept"] for r in got) and len(got) == len(texts)
    assert left[0] <= 2


@pytest.mark.parametrize("listed", [minhash.LISTED, minhash.KEPT])
def test_shared_is_a_lower_bound(spark, listed):
    """No partner at 0.8 or more has fewer listed values in common, even if it lacks the least ones."""
    draw = np.random.default_rng(5)
    bounds = spark.range(1, listed + 1).select("id", minhash.shared(minhash.F.col("id"), listed).alias("bound")).collect()
    for n, bound in bounds:
        for _ in range(60):
            x = np.unique(draw.integers(1 << 61, 1 << 62, n))
            more = draw.integers(0, n // 4 + 1)
            less = draw.integers(0, max(0, (n - 4 * more) // 5) + 1)
            y = np.unique(np.concatenate([x[less:], draw.integers(0, 1 << (62 - draw.integers(2)), more)]))
            both = len(np.intersect1d(x, y))
            if 5 * both >= 4 * (len(x) + len(y) - both):
                assert len(np.intersect1d(x[:listed], y[:listed])) >= bound


@pytest.mark.parametrize("listed, tail", [(minhash.LISTED, 1e-9), (minhash.KEPT, 2e-9)])
def test_shared_fails_for_long_sets_once_in_a_billion(listed, tail):
    """Of the least values of a union each is in both sets with the chance of the similarity."""
    chance = sum(math.comb(listed, k) * 0.8 ** k * 0.2 ** (listed - k) for k in range(minhash.SHARED[listed]))
    assert chance < tail


def test_query(spark):
    from growthlake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert answers(QUERIES["op13_minhash_near_dedup"](spark, sf).select(*COLUMNS).collect()) == answers(
        brute.similar_sets(rows))
