"""Each operator on odd rows against brute force, on an empty table, and its parts on their own."""

import io
import itertools
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from brute import prose
from growthlake.llm import (
    chat, decontamination, lines, mixing, personal_data, pfor, quality_outliers, secret_scan, simhash, substrings,
    token_files,
)
from growthlake.llm.common import components
from pyspark.sql import functions as F

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(got, expected):
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_simhash_classes(odd, odd_rows, empty):
    prints = [brute.fingerprint(r[1]) for r in odd_rows]
    near = brute.classes([r[0] for r in odd_rows], lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 4)
    same(rows(simhash.near_duplicate_classes(odd)),
         [(r[0], f"{p:016x}", c) for r, p, c in zip(odd_rows, prints, near)])
    assert rows(simhash.near_duplicate_classes(empty)) == []


def test_exact_tables_meet_every_pair_within_the_limit():
    draw = random.Random(1)
    for limit in (1, 3, 4, 7):
        tables = simhash.exact_tables(limit)
        for _ in range(300):
            differ = sum(1 << b for b in draw.sample(range(64), limit))
            assert any(differ & mask == 0 for mask in tables)


def test_coordinates_discard_pairs_and_lose_no_link(spark):
    draw = random.Random(8)
    base = [draw.getrandbits(64) for _ in range(60)]
    prints = {x ^ sum(1 << draw.randrange(64) for _ in range(k)) & (1 << 64) - 1 for x in base for k in range(6)}
    # all agree on the low 32 bits, so many pairs meet that are no links
    prints = sorted({simhash._signed(x >> 32 << 32 | 7) for x in prints})
    nodes = spark.createDataFrame([(x, x) for x in prints], "node long, fp long")
    pairs = [(a, b) for i, a in enumerate(prints) for b in prints[:i]]
    near = [p for p in pairs if ((p[0] ^ p[1]) & (1 << 64) - 1).bit_count() <= 4]
    found = simhash.pivot_counts(nodes, [(1 << 32) - 1], 4).first()
    far = [max(abs(((a ^ p) & (1 << 64) - 1).bit_count() - ((b ^ p) & (1 << 64) - 1).bit_count())
               for p in simhash.pivots()) for a, b in pairs]
    assert (found.met, found.passed, found.linked) == (len(pairs), sum(f <= 4 for f in far), len(near))
    assert found.linked < found.passed < 0.2 * found.met


def test_simhash_links_a_chain(spark):
    """Fingerprints in steps of four bits are one class, though its ends differ by far more."""
    prints = [(i, sum(1 << b for b in range(4 * i))) for i in range(12)] + [(99, 0x5555_5555_5555_5555)]
    nodes = spark.createDataFrame(prints, "node long, fp long")
    found = dict(rows(simhash.link_components(nodes, simhash.exact_tables(4), 4)))
    assert {found.get(i, i) for i in range(12)} == {0} and found.get(99, 99) == 99


def test_without_near_copies(odd, odd_rows, empty):
    left = simhash.without_near_copies(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert {0, 3, 4, 9, 13, 14, None} <= set(ids) and not {1, 2, 5, 6, 7, 8} & set(ids)
    assert max(Counter(ids).values()) == 1
    assert rows(simhash.without_near_copies(empty)) == []


def test_of_each_class_of_fingerprints_the_least_document_stays(spark):
    """Copies with a few words changed, against a search over all pairs of fingerprints."""
    draw, texts = random.Random(12), []
    for i in range(60):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(80, 400))]
        other = list(words)
        for _ in range(draw.randint(0, 3)):
            other[draw.randrange(len(words))] = f"v{draw.randrange(5000)}"
        texts += [" ".join(words), " ".join(other)]
    prints = [brute.fingerprint(t) for t in texts]
    apart = [(prints[i] ^ prints[i + 1]).bit_count() for i in range(0, len(texts), 2)]
    assert sum(d <= 4 for d in apart) > 10 and sum(d > 4 for d in apart) > 10
    expected = brute.classes(range(len(texts)), lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "node long, text string").selectExpr("node AS doc_id", "text", "7 AS node", "'c' AS copy")
    left = simhash.without_near_copies(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(expected)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = dict(rows(components(spark.createDataFrame(links, "a long, b long"))))
    assert set(found[i] for i in range(21)) == {0} and set(found[i] for i in range(100, 130)) == {100}


def test_tokens_round_trip(odd, odd_rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected, start = [], 0
    for r in sorted(odd_rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    same(rows(token_files.token_table(odd, TOKENIZER)), expected)
    assert rows(token_files.token_table(empty, TOKENIZER)) == []


def test_pieces_encode_like_whole_texts():
    encoder = token_files.Encoder(TOKENIZER)
    draw = random.Random(3)
    parts = ["a", "B,", " ", "  ", "\n", " \n", "'s", "don't", "12", "3.4", "\t", " ", "é", "中", "😀", ".", ",", "<|endoftext|>", "word"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    for _ in range(2):
        assert encoder.encode(texts) == encoder._whole(texts)


def test_pieces_of_many_generations(monkeypatch):
    monkeypatch.setattr(token_files, "GENERATION_PIECES", 40)
    encoder = token_files.Encoder(TOKENIZER)
    draw = random.Random(4)
    words = ["".join(draw.choices("abcé1'.,\n", k=draw.randint(1, 6))) for _ in range(300)]
    for _ in range(40):
        texts = [None, "", *(" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(10))]
        assert encoder.encode(texts) == encoder._whole([t or "" for t in texts])
    assert len(encoder.known.number) < 1000


def test_rows_of_one_id_fill_several_shards(spark, tmp_path):
    # ranges this small would be joined to one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _several_shards(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _several_shards(spark, tmp_path):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(400)], "doc_id long, text string").repartition(4)
    manifest = token_files.write_shards(docs, f"file://{tmp_path}/shards", TOKENIZER)
    assert manifest.count() > 1 and manifest.agg({"n_docs": "sum"}).first()[0] == 400
    found = token_files.read_shards(manifest)
    assert [r.start for r in found.orderBy("start").collect()] == list(itertools.accumulate(
        [r.n_tokens for r in found.orderBy("start").collect()][:-1], initial=0))


@pytest.mark.parametrize("values", [
    [7], [0] * 70_000, [-(2 ** 63), 2 ** 63 - 1, 0], list(range(200_000)), [5] * 1000 + [2 ** 40] + [6] * 100])
def test_blocks_round_trip(values):
    values = np.array(values, np.int64)
    out = io.BytesIO()
    writer = pfor.ShardWriter(out)
    writer.add([None, 3], [1, len(values) - 1], values)
    writer.close()
    reader = pfor.ShardReader(out, len(out.getvalue()))
    assert (reader.slice("tokens", 0, len(values)) == values).all()
    assert (reader.slice("tokens", len(values) // 2, len(values)) == values[len(values) // 2:]).all()
    (first, a), (second, b) = reader.documents()
    assert (first, second) == (None, 3) and (np.concatenate([a, b]) == values).all()


def test_mixture(odd, odd_rows, empty):
    got = mixing.mixture(odd).collect()
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += len(brute.words(r[1]))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    targets, open_, left = {}, set(names), sum(sizes.values())
    while True:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level > 3 * sizes[s]}
        if not full:
            break
        for s in full:
            targets[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= full
    targets |= {s: weights[s] * level for s in open_}
    same([(r.doc_id, r.size) for r in got], [(r[0], len(brute.words(r[1]))) for r in odd_rows])
    source = {r[0]: r[3] for r in odd_rows}
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(targets[source[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    longest = {s: max(len(brute.words(r[1])) for r in odd_rows if r[3] == s) for s in names}
    assert all(abs(taken[s] - targets[s]) <= longest[s] for s in names)
    assert rows(mixing.mixture(odd)) == rows(mixing.mixture(odd.repartition(5)))
    assert rows(mixing.mixture(empty)) == []


def test_mixed_repeats_rows(odd, empty):
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    wanted = {r.doc_id: r.taken // r.size for r in mixing.mixture(odd.distinct()).collect() if r.size}
    assert Counter(r.doc_id for r in mixed.collect()) == {d: n for d, n in wanted.items() if n}
    assert rows(mixing.mixed(empty)) == []


def test_budget_is_met_exactly():
    draw = random.Random(5)
    for _ in range(200):
        sizes = sorted(draw.sample(range(1, 300), 20))
        counts = [draw.randint(1, 30) for _ in sizes]
        budget = draw.randint(0, sum(s * c for s, c in zip(sizes, counts)))
        take = mixing.fit_budget(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        used = sum(s * t for s, t in zip(sizes, take))
        assert used <= budget and budget - used <= min(sizes)


def test_budget_of_long_documents_is_met():
    assert mixing.fit_budget([9000, 10000, 11000], [1, 1, 1], 20000) == [1, 0, 1]
    assert mixing.fit_budget([70_001, 80_000, 90_003], [1, 2, 1], 160_004) == [1, 0, 1]
    draw = random.Random(6)
    for _ in range(30):
        sizes = sorted(draw.sample(range(5000, 60_000), 9))
        made = {0}
        for s in sizes:
            made |= {m + s for m in made}
        budget = draw.randint(0, max(made))
        used = sum(s * t for s, t in zip(sizes, mixing.fit_budget(sizes, [1] * 9, budget)))
        assert max(m for m in made if m <= budget) == used


def test_a_hot_size_is_ranked_in_parts(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "'a b c' AS text", "'s' || id % 2 AS source")
    got = mixing.mixture(docs).groupBy("source_size").sum("taken").collect()
    assert 15_000 - 6 < sum(r["sum(taken)"] for r in got) <= 15_000


def test_quality_statistics(odd, odd_rows, empty):
    def expected(text):
        w = brute.words(text)
        repeats = brute.repeat_words(text)
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), brute.duplicate_lines(text), repeats,
                len(w) < 50 or 100 * repeats > 50 * len(w))

    got = quality_outliers.quality(odd).drop("distance")
    same([tuple(r)[:7] for r in got.collect()], [(r[0], *expected(r[1])) for r in odd_rows])
    assert all(not (r.base_failed and r.kept) for r in got.collect())
    assert rows(quality_outliers.quality(empty)) == []


def test_quality_rejects_outliers_and_keeps_columns(spark, empty):
    clean = [(i, prose(i, 60 + i), "en", "s") for i in range(150)]
    junk = [(1000 + i, " ".join(w + "$$$&&&" for w in prose(500 + i, 80).split()), "en", "s") for i in range(15)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    left = quality_outliers.of_quality(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == set(range(150))
    assert rows(quality_outliers.of_quality(empty)) == []


def test_quality_of_labelled_rows(spark):
    """Junk goes, clean documents stay, and a long clean one too."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    long = spark.createDataFrame(
        [(-1, " ".join(f"w{i % 50:02d}{'abcdefgh'[:i % 7]}{i}" for i in range(100_000)), "en", "web")],
        "doc_id long, text string, lang string, source string")
    verdicts = quality_outliers.quality(docs.select(long.columns).unionByName(long)).where("NOT base_failed").join(labels, "doc_id", "left")
    found = {(r.quality, r.kept): r.n for r in verdicts.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert found.get((0, True), 0) <= 0.01 * found[0, False]
    assert found.get((1, False), 0) <= 0.01 * found[1, True]
    assert verdicts.where("doc_id = -1").head().kept


def test_chi_square():
    assert quality_outliers.chi2_cdf(quality_outliers.chi2_quantile(0.75, 5), 5) == pytest.approx(0.75)
    assert quality_outliers.chi2_quantile(0.95, 1) == pytest.approx(3.841, abs=1e-3)


def test_personal_data(odd, odd_rows, empty):
    got = {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone): r.spans for r in personal_data.digest(
        personal_data.personal_spans(odd)).collect()}
    for r in odd_rows:
        spans = brute.base_spans(r[1])
        counts = [sum(s.startswith(kind) for s in spans) for kind in ("email", "ip", "card", "phone")]
        assert set(spans) <= set(filter(None, got[(r[0], brute.sha(",".join(spans)), *counts)].split(",")))
    assert rows(personal_data.personal_spans(empty)) == []


def test_personal_data_patterns(spark):
    texts = [
        "a@b.c-x@d.e", "a@b.c_x@d.e @@ a@b", "1.2.3.4.5.6.7.8 001.2.3.4 256.1.1.1", "4111-1111-1111-1112 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
        "+1 (555) 123-4567 +49 30 1234567. +1 2 +12", "😀 a@b.co 😀 1.1.1.1", "a.b" * 20_000, "+1" * 2_000, "x" * 60_000 + "@"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data.digest(personal_data.personal_spans(docs)).collect():
        assert r.base_sha256 == brute.sha(",".join(brute.base_spans(texts[r.doc_id])))


def test_labeler_reliabilities():
    """A good labeler, a coin and one that abstains: the good one is trusted."""
    draw, patterns = random.Random(2), Counter()
    truth = []
    for _ in range(4000):
        true = draw.random() < 0.5
        votes = [1 if (draw.random() < 0.95) == true else -1, 1 if (draw.random() < 0.9) == true else -1,
                 draw.choice((-1, 1)), 0, 1 if (draw.random() < 0.85) == true else -1]
        patterns[tuple(votes)] += 1
        truth.append((tuple(votes), true))
    listed = sorted(patterns.items())
    _, tables, posterior = personal_data.reliabilities(listed)
    of = dict(zip((v for v, _ in listed), posterior))
    assert sum((of[v] > 0.5) == t for v, t in truth) / len(truth) > 0.95
    assert tables[0][1][0] / tables[0][1][1] > 5 > tables[2][1][0] / tables[2][1][1]


def test_substring_dedup(odd, odd_rows, empty):
    last = substrings.LAST_ID
    expected = []
    for (i, _), (w, gone) in zip([(r[0], r[1]) for r in odd_rows], brute.removed_windows(
            [(last if r[0] is None else r[0], r[1]) for r in odd_rows])):
        expected.append((i, len(w), sum(gone), brute.sha(" ".join(x for x, g in zip(w, gone) if not g))))
    same(rows(substrings.digest(substrings.without_repeats(odd))), expected)
    assert rows(substrings.without_repeats(empty)) == []


def test_cover_aligns_any_two_places():
    for shift in range(substrings.PERIOD):
        assert any((a + shift) % substrings.PERIOD in substrings.COVER for a in substrings.COVER)


def test_line_edit_distance_and_probes():
    draw = random.Random(4)
    for _ in range(6000):
        a = "".join(draw.choice("abc") for _ in range(draw.randint(0, 14)))
        b = list(a)
        for _ in range(draw.randint(0, 4)):
            at = draw.randint(0, len(b))
            b[at:at + draw.randint(0, 1)] = draw.choice(["", "a", "b", "c"])
        b = "".join(b)
        for edits in (1, 2, 3):
            near = brute.edit_distance(a, b) <= edits
            assert lines.within(a, b, edits) == near
            x, y = (a, b) if len(a) >= len(b) else (b, a)
            if near and len(y) > edits:
                whole = {(k, y[s:s + n]) for k, (s, n) in enumerate(lines.segments(len(y), edits))}
                assert any((k, x[s:s + n]) in whole for k, s, n in lines.probes(len(x), len(y), edits))


def test_line_dedup(odd, odd_rows, empty):
    docs = sorted({(substrings.LAST_ID if r[0] is None else r[0], r[1] or "") for r in odd_rows})
    places = [(i, k, line) for i, text in docs for k, line in enumerate(lines.lines_of(text)) if len(line) < 2000]
    distinct = sorted({line for *_, line in places})
    near = brute.classes(range(len(distinct)), lambda x, y: lines.within(distinct[x], distinct[y], 2))
    of = dict(zip(distinct, near))
    first = {}
    for i, k, line in places:
        first.setdefault(of[line], (i, k))
    gone = Counter(i for i, k, line in places if first[of[line]] != (i, k))
    # one huge line occurs twice: the row that is repeated as a whole counts once
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in lines.removal_counts(odd).collect()}
    for i, text in docs:
        if all(len(x) < 2000 for x in lines.lines_of(text)):
            assert got[None if i == substrings.LAST_ID else i] == (len(lines.lines_of(text)), gone[i])
    kept = {r.doc_id: r.kept_text for r in lines.without_repeated_lines(odd).collect()}
    assert kept[15] == "same line here" and "words 2" not in kept[21] and "words 3" not in kept[22]
    assert rows(lines.removal_counts(empty)) == []


def _edited(rng, line, edits, letters):
    out = list(line)
    for _ in range(edits):
        at = rng.randint(0, len(out))
        out[at:at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters)])
    return "".join(out)


def test_near_copies_share_a_key():
    rng = random.Random(8)
    for edits in (1, 2, 3):
        pairs = []
        for k in range(400):
            letters = ("ab", "abcdefgh ", "a", "xyz")[k % 4]
            one = "".join(rng.choice(letters) for _ in range(rng.randint(5 * edits, 150 if k % 5 else 600)))
            one = (one[:3] * len(one))[:len(one)] if k % 7 == 0 else one
            pairs.append((one, _edited(rng, one, edits, letters + "z")))
        described = [lines._described([p[side] for p in pairs], edits) for side in (0, 1)]
        keys = [d[2].to_pylist() for d in described]
        for k, (one, other) in enumerate(pairs):
            if min(len(one), len(other)) < 5 * edits:
                continue
            assert lines.within(one, other, edits)
            counts = [int(d[1][k]) for d in described]
            steps = [(counts[0] >> 4 * lane) - (counts[1] >> 4 * lane) for lane in range(16)]
            assert sum(min(x & 15, -x & 15) for x in steps) <= 2 * edits
            for mine, its in ((keys[0][k], keys[1][k]), (lines.joint_keys(one, edits), lines.joint_keys(other, edits))):
                probed = {x >> 1: x & 1 for x in its}
                # one of the two has it as its own
                assert any(x >> 1 in probed and not (x & 1 and probed[x >> 1]) for x in mine)
    # a long line has few keys
    many = ["".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(200)]
    assert len(lines._described(many, 2)[2].flatten()) < 7 * len(many)


def test_very_long_lines_are_described_in_pieces(monkeypatch):
    rng = random.Random(10)
    long = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (150, 998, 999, 1000, 1001, 2500)]
    every = [*long, *(_edited(rng, x, 2, "xyz") for x in long), "", "}"]
    whole = lines._described(every, 2)
    monkeypatch.setattr(lines, "PIECE", 1000)
    pieces = lines._described(every, 2)
    assert whole[0].tolist() == pieces[0].tolist() and whole[1].tolist() == pieces[1].tolist()
    keys = pieces[2].to_pylist()
    assert keys[0] == whole[2].to_pylist()[0]
    for one, other in zip(keys, keys[len(long):2 * len(long)]):
        probed = {x >> 1: x & 1 for x in other}
        assert any(x >> 1 in probed and not (x & 1 and probed[x >> 1]) for x in one)


def test_a_passage_at_many_places_does_not_pair_lines_up():
    rng = random.Random(12)
    draw = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    most = 0
    for _ in range(20):
        passage, many = draw(80), []
        for _ in range(300):
            at, n = rng.randint(0, 300), rng.randint(400, 415)
            many.append("x" + draw(at) + passage + draw(n - 82 - at) + "x")
        keys = lines._described(many, 2)[2]
        most = max(most, *Counter(keys.flatten().to_pylist()).values())
        # copies still share a key, wherever the edits move it
        near = lines._described([_edited(rng, x, 2, "xyz") for x in many], 2)[2]
        assert all(set(mine) & set(its) for mine, its in zip(keys.to_pylist(), near.to_pylist()))
    assert most <= lines.OFTEN


def test_lines_that_repeat_themselves_give_all_their_grams():
    rng = random.Random(13)
    for unit in ("a", "ab", "abc def ", "-" * 30 + "|"):
        for n in (64, 95, 200, 3000):
            one = (unit * n)[:n]
            keys = lines._described([one, *(_edited(rng, one, 2, "xyz") for _ in range(20))], 2)[2].to_pylist()
            assert all(set(keys[0]) & set(other) for other in keys[1:])
            assert all(len(set(k)) == len(k) for k in keys)


def test_pair_filter_holds_lengths_and_counts_against_the_edits(spark):
    rng = random.Random(14)
    pairs = []
    for _ in range(3000):
        a = [rng.randrange(16) for _ in range(16)]
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(16)
            b[at] = (b[at] + rng.choice((-2, -1, 1, 2))) % 16
        pairs.append((a, b, rng.randint(100, 103), 100))
    packed = lambda x: int(np.uint64(sum(v << 4 * k for k, v in enumerate(x))).view(np.int64))
    given = spark.createDataFrame(
        [(k, packed(a), packed(b), m, n) for k, (a, b, m, n) in enumerate(pairs)],
        "k int, a_counts long, b_counts long, a_size int, b_size int")
    for edits in (1, 2, 3):
        expected = {
            k for k, (a, b, m, n) in enumerate(pairs)
            if abs(m - n) <= edits and sum(min((x - y) % 16, (y - x) % 16) for x, y in zip(a, b)) <= 2 * edits}
        assert {r.k for r in given.where(lines._possible(edits)).collect()} == expected and expected


def test_copies_with_many_changes_do_not_pair_up(spark, monkeypatch):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(50)]
    changed = []
    for _ in range(400):
        line = list(words)
        for at in rng.sample(range(len(line)), 3):
            line[at] = "".join(rng.choice("klmnopqrst") for _ in range(7))
        changed.append(" ".join(line))
    near = [_edited(rng, changed[k], 2, "xyz") for k in range(0, 400, 20)]
    # a letter of a passage that all have, and one of each line's own words
    near += [changed[k].replace(words[3], words[3][:-1], 1) for k in range(5, 400, 20)]
    met = Counter()
    keep = lines.stored

    def counted(df, name):
        out = keep(df, name)
        met[name] += out.count()
        return out

    monkeypatch.setattr(lines, "stored", counted)
    docs = spark.createDataFrame(list(enumerate([*changed, *near])), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.n_removed for r in lines.removal_counts(docs).collect()}
    every = [*changed, *near]
    of = brute.classes(range(len(every)), lambda x, y: lines.within(every[x], every[y], 2))
    assert got == {k: int(of[k] != k) for k in range(len(every))} and sum(got.values()) >= len(near) - 2
    assert met["pairs"] < 2 * len(every)


def test_different_short_lines_stay(spark):
    short = ["}", "1", "A", "OK", "Item 1", "Item 2", "1998", "1999", "red", "bed", "read on"]
    texts = ["\n".join(short), "\n".join(["}", "Item 3", "2001", "a line of some length 1", "a line of some length 22"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(lines.removal_counts(docs)) == [(0, len(short), 0, ""), (1, 5, 2, "0,4")]


def test_decontamination(spark, odd, odd_rows, empty):
    items = [(1, prose(1, 120)[:200]), (2, "one two three"), (3, None), (4, "!!"), (5, prose(2, 90)[100:180]), (5, prose(2, 90)[100:180]),
             (6, "中文 words")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, text in items:
        w = decontamination.split_words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(i)
    expected = []
    for r in odd_rows:
        w, hit, found = decontamination.split_words(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k:k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[key]
        expected.append((r[0], len(w), len(hit), sorted(found)))
    tidy = lambda df: [(r[0], r[1], r[2], sorted(set(r[3]))) for r in rows(df)]
    same(tidy(decontamination.contamination(odd, benchmark)), expected)
    by_id = dict((e[0], e) for e in expected)
    blocks = {r[0]: r for r in tidy(decontamination.contamination(odd, benchmark, block_words=8))}
    assert blocks == by_id
    clean = decontamination.decontaminated(odd, benchmark)
    assert clean.columns == odd.columns
    same([r.doc_id for r in clean.collect()], [e[0] for e in expected if not e[2]])
    same(tidy(decontamination.contamination(odd, benchmark.limit(0))), [(e[0], e[1], 0, []) for e in expected])
    assert rows(decontamination.contamination(empty, benchmark)) == []


def test_many_blocks_give_the_rows_of_one(spark):
    """Null ids and one id with several texts: each row is judged on its own, however the benchmark is cut."""
    a, b, c = prose(1, 40), prose(2, 40), prose(3, 40)
    benchmark = spark.createDataFrame(
        [(1, a[:150]), (2, b[:150]), (2, a[60:200]), (None, b[30:180])], "item_id long, text string")
    docs = spark.createDataFrame(
        [(None, a), (None, c), (7, b), (7, c), (7, a + " " + b), (8, None), (9, c), (9, c)], "doc_id long, text string")
    one = rows(decontamination.contamination(docs, benchmark))
    assert one == rows(decontamination.contamination(docs, benchmark, block_words=20))
    assert sum(r[2] > 0 for r in one) == 3 and sum(r[0] is None and r[2] > 0 for r in one) == 1
    left = rows(decontamination.decontaminated(docs, benchmark))
    assert left == rows(decontamination.decontaminated(docs, benchmark, block_words=20)) and len(left) == 5


def test_longest_matches(spark):
    item = "a b c d e f g h i j k l m n"
    docs = spark.createDataFrame([(1, "z a b c d e f g h i j k l q " + item), (2, "a b c d e f g h i")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert rows(decontamination.longest_matches(docs, benchmark)) == [(1, 7, 1, 12), (1, 7, 14, 14)]


def test_secrets(odd, empty):
    found = [r for r in secret_scan.secrets(odd).collect() if r.is_secret]
    assert [(r.doc_id, r.value) for r in found] == [(20, "8f3a0c9d1b7e4f6a8c2d5e9f0a1b3c4d5e6f7a8b")]
    assert rows(secret_scan.secrets(empty)) == []


def test_secret_places(spark):
    texts = ["é key=" + "Ab3" * 8 + " and " + "z9" * 10 + "== end", "no", None, "q" * 15, "q" * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'conf/app.env' AS source")
    for r in secret_scan.findings(docs).collect():
        assert texts[r.doc_id][r.start:r.end] == r.value
        assert texts[r.doc_id][:r.start].endswith(r.left) and texts[r.doc_id][r.end:].startswith(r.right)
    assert secret_scan.findings(docs).count() == 3


def test_secrets_after_long_names(spark):
    """A variable name of 16 characters or more is a candidate too, and still the words beside the secret."""
    draw, texts = random.Random(4), []
    names = ["AWS_SECRET_ACCESS_KEY=", "GITHUB_ACCESS_TOKEN=", 'DATABASE_PASSWORD: "', "PAYMENT_API_TOKEN_LIVE = '"]
    for i in range(40):
        value = "".join(draw.choice("0123456789abcdefghijkLMNOPQRSTUVWXYZ") for _ in range(32))
        texts.append(f"some words\n{names[i % 4]}{value}\nUNRELATED_IDENTIFIER_OF_LENGTH_{i} 😀 end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'app.env' AS source")
    found = secret_scan.findings(docs).collect()
    assert len(found) == 120
    for r in found:
        text = texts[r.doc_id]
        assert r.left == text[max(0, r.start - 40):r.start] and r.right == text[r.end:r.end + 40]
    secrets = {(r.doc_id, r.value[:3]) for r in secret_scan.secrets(docs).collect() if r.is_secret}
    assert secrets == {(i, t.split("\n")[1][len(names[i % 4]):][:3]) for i, t in enumerate(texts)}


def test_dictionary_has_no_pieces_of_candidates(spark):
    """A secret in many texts, and one text in many copies, make no words; words of a share of the texts do."""
    draw = random.Random(9)
    texts = [f"plain word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]} token=qwe7rty8uio9pas0dfg1 end" for i in range(60)]
    texts += ["copied letters only"] * 40 + [prose(draw.randrange(1000), 60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.word for r in secret_scan.dictionary(docs).collect()}
    assert {"plain", "token", "end"} <= found and not found & {"qwe", "rty", "uio", "pas", "dfg", "copied", "letters"}
    assert {r.word for r in secret_scan.dictionary(docs, 0.99).collect()} == set()


def test_forest_on_held_out_findings(spark):
    """Labels that no single feature gives away; the forest is right on findings that it hasn't seen."""
    draw, texts, truth = random.Random(8), [], []
    for i in range(600):
        secret = i % 2 == 0
        value = "".join(draw.choice("0123456789abcdefGHIJKLMNOP") for _ in range(32)) if secret else "".join(
            draw.choice(["Value", "Index", "Handler", "Table"]) for _ in range(6))
        before = draw.choice(["key = ", "see ", "uses "]) if secret else draw.choice(["key = ", "name ", "call "])
        texts.append((i, f"some words {before}{value} after"))
        truth.append(float(secret))
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'a' AS source")
    features = secret_scan.with_features(secret_scan.findings(docs), secret_scan.dictionary(docs))
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(truth)], "doc_id long, label double")
    both = features.join(labels, "doc_id")
    test = secret_scan.scored(both.where("doc_id % 5 = 0"), both.where("doc_id % 5 <> 0")).collect()
    assert sum((r.score >= 0.5) == (r.label == 1) for r in test) / len(test) > 0.97


def test_perspectives(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "héllo"), (1, 3, "ann", None), (1, 3, "ann", None),
        (2, 0, "system", "alone"), (None, 5, None, "who?"), (3, 2000, "bob", "late"), (3, 1, "ann", "early"), (3, None, "ann", "first")]
    docs = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "'p' AS perspective", "1 AS part")
    found = chat.perspectives(docs).collect()
    assert {(r.conv_id, r.perspective, r.part) for r in found} == {
        (1, "ann", 0), (1, "bob", 0), (None, "unknown", 0), (3, "ann", -1), (3, "ann", 0), (3, "ann", 1), (3, "bob", -1), (3, "bob", 0), (3, "bob", 1)}
    one = next(r for r in found if (r.conv_id, r.perspective) == (1, "ann"))
    assert one.n_turns == 4 and one.rendered == (
        "<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user name=bob|>\nhéllo<|end|>\n<|assistant|>\n<|end|>\n")
    trained = [one.rendered[int(a):int(b)] for a, b in (s.split(":") for s in one.spans.split(","))]
    assert trained == ["hi<|end|>", "<|end|>"] and one.n_trained == sum(map(len, trained))
    parts = sorted((r for r in found if (r.conv_id, r.perspective) == (3, "bob")), key=lambda r: r.part)
    assert [r.start for r in parts] == [0, len(parts[0].rendered), len(parts[0].rendered + parts[1].rendered)]
    assert chat.perspectives(docs.limit(0)).collect() == []


def test_perspectives_of_a_hot_conversation(spark):
    """Rows without a conversation or turn, and many rows of few turn numbers: no row has more turns than a part."""
    turns = [(None, None if i % 2 else i % 7, "ann" if i % 3 else "bob", f"turn {i:03d} é") for i in range(300)]
    turns += [(1, i % 4, "ann", f"text {i}") for i in range(100)] + [(2, i, "bob", "few") for i in range(20)]
    docs = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    found = chat.perspectives(docs, part_turns=16).collect()
    assert max(r.n_turns for r in found) == 16
    for conv, who in ((None, "ann"), (None, "bob"), (1, "ann"), (2, "bob")):
        mine = sorted((r for r in found if (r.conv_id, r.perspective) == (conv, who)), key=lambda r: (r.part, r.start))
        whole = "".join(r.rendered for r in mine)
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (-1 if t[1] is None else t[1], t[2], t[3]))
        assert whole == "".join(
            f"<|{'assistant' if t[2] == who else 'user name=' + t[2]}|>\n{t[3]}<|end|>\n" for t in own)
        assert all(r.start == sum(len(q.rendered) for q in mine[:k]) for k, r in enumerate(mine))
