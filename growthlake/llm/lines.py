"""Line dedup with a segment-partition edit join.

Lines that differ by at most ``edits`` edits are near copies, if both have at
least ``SHORTEST`` times as many characters; shorter lines only if equal, as a
few edits make any short line of any other. Keys pair lines up, so that near
copies share one for certain, and a bounded edit distance verifies.

* Lines of less than ``GRAMS_FROM`` characters are cut into ``edits + 1``
  segments; whatever the edits, one stays whole, shifted by no more places than
  the edits can shift it. A line's own segments are its index; it also probes,
  for its own length and those up to ``edits`` below, the substrings that can
  be such a segment.
* An edit spoils only one of several grams (substrings of one length) that do
  not overlap. So longer lines take their grams in the order of a hash, up to
  one that makes ``edits + 1`` of them apart: the edits leave one of these, and
  the near copy, whose own go up to a later or the same hash, has it too. The
  length of a gram follows ranges of the lines' length; a line near the end of
  its range has keys for the next one also. So it is with a gram's place, which
  the edits shift by no more places than there are: lines that have a passage
  in common, but at another place, don't meet.
* A key of more than ``OFTEN`` lines (of a passage in many of them) yields no
  pairs. Its lines get keys of a second kind: a line in ``edits + 6`` parts
  without ``edits`` of them, so that lines which have only a passage in common,
  or copies with many changes, seldom meet. Lines with such a key are left, as
  a star, to its least one first; pairs are made only between lines that this
  left in different classes.

Lengths and counts of characters, which travel with a line's number, rule out
most pairs before a text is read. Texts stay where they are but for those of
pairs left and of the lines of frequent keys.

Equal lines are one line from the start. Keys are joined so that AQE splits the
hot ones. Classes follow links; of each class the first occurrence stays (least
doc_id, then line number), all others are removed.

Cases: null and empty texts have no lines; lines without a visible character
are neither counted nor removed; lines are compared by code points after
trimming; rows with equal doc_id and text count once, other rows with an
equal doc_id are told apart by a hash of their text; null ids come last; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import components, forget, small_batches, stored

EDITS = 2
# lines of fewer characters than this many times the edits are copies only if equal
SHORTEST = 5
# lines of so many characters have grams as keys, of at most GRAM characters; their lengths are told apart by RANGE
GRAMS_FROM = 64
GRAM = 16
RANGE = 16
JOINT_RANGE = 8
# a gram's place, too, is told apart by so many characters
PLACES = 16
# keys of more lines than this don't pair them up: a line would meet about as many others as it has joint keys
OFTEN = 128
LANES = 16
# grams of a line that are looked at first
FEW = 16
# about so many characters are hashed at a time, or those of a longer line, if not more than PIECE
BATCH = 1 << 16
PIECE = 1 << 20
LAST_ID = (1 << 63) - 1


def lines_of(text: str | None) -> list[str]:
    """The lines with a visible character, trimmed."""
    return [x for line in (text or "").split("\n") if (x := line.strip())]


def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """(start, length) of the parts of a line of n characters, as even as can be, the longer ones last."""
    parts = edits + 1
    short, longer = divmod(n, parts)
    out, at = [], 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(n: int, length: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment, start, size): what a line of n characters looks up among lines of ``length``.

    A segment can be shifted by the edits before it and by those after it, and
    with the first whole segment at number k there are at least k edits before.
    """
    out, apart = [], n - length
    for k, (at, size) in enumerate(segments(length, edits)):
        low = max(0, at - k, at + apart - (edits - k))
        high = min(n - size, at + k, at + apart + (edits - k))
        out += [(k, start, size) for start in range(low, high + 1)]
    return out


def _alike(a: str, i: int, b: str, j: int) -> int:
    """How many characters from a[i] and b[j] on are equal."""
    most, done, step = min(len(a) - i, len(b) - j), 0, 16
    while done < most and a[i + done:i + done + step] == b[j + done:j + done + step]:
        done, step = done + step, 2 * step
    if done >= most:
        return most
    # they differ within the next ``step`` characters: halve
    step = min(step, most - done)
    while step > 1:
        half = step // 2
        if a[i + done:i + done + half] == b[j + done:j + done + half]:
            done, step = done + half, step - half
        else:
            step = half
    return done + (a[i + done:i + done + 1] == b[j + done:j + done + 1])


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: furthest reach on each diagonal, one more error at a time."""
    apart = len(b) - len(a)
    if abs(apart) > edits:
        return False
    # diagonal (place in b less place in a) -> characters of a that are matched with so many errors
    reach: dict[int, int] = {}
    for errors in range(edits + 1):
        after = {}
        for d in range(-errors, errors + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1) if errors else 0
            i = min(i, len(a), len(b) - d)
            if i >= 0 and i + d >= 0:
                after[d] = i + _alike(a, i, b, i + d)
        reach = after
        if reach.get(apart) == len(a):
            return True
    return False


def _key(n: int, segment: int, part: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{n}:{segment}:{part}".encode("utf-8", "surrogatepass")) >> 2


@lru_cache(maxsize=1 << 10)
def _cuts(n: int, edits: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """(segment, start, stop) of a line of n characters; (length, segment, start, stop) of what it probes."""
    short = max(SHORTEST * edits, 1)
    return (
        [(k, at, at + size) for k, (at, size) in enumerate(segments(n, edits)) if n >= short],
        [(length, k, at, at + size) for length in range(max(n - edits, short), n + 1) for k, at, size in probes(n, length, edits)])


def short_keys(line: str, edits: int) -> list[int]:
    """Keys of a line by segments; the lowest bit is set on those that it only probes."""
    own, asked = _cuts(n := len(line), edits)
    own = {_key(n, k, line[at:stop]) for k, at, stop in own}
    asked = {_key(length, k, line[at:stop]) for length, k, at, stop in asked} - own
    return [k * 2 for k in own] + [k * 2 + 1 for k in asked]


def joint_keys(line: str, edits: int) -> list[int]:
    """Keys, as above, of all of a line but ``edits`` of its parts: what near copies have in common beside the edited ones.

    What is before the first part left out is measured from the left, what is
    after the last one from the right; only what is between two of them may be
    shifted, by one place more for each (edits in one part count as edits of
    its neighbours too). Parts are of one size for a range of lengths.
    """
    n, parts = len(line), edits + 6
    own, asked = set(), set()
    for span in {n // JOINT_RANGE, (n + edits) // JOINT_RANGE}:
        size = max(span * JOINT_RANGE - edits, SHORTEST * edits, 1) // parts
        for number, gone in enumerate(combinations(range(parts), edits)):
            between = [(size * (x + 1), size * y) for x, y in zip(gone, gone[1:])]
            ends = line[:size * gone[0]] + line[n - size * (parts - 1 - gone[-1]):]
            for steps in product((0, -1, 1), repeat=len(between)):
                middle = [(stop > start and shift, line[start + shift:stop + shift] if stop > start else "")
                          for (start, stop), shift in zip(between, accumulate(steps))]
                moved = any(shift for shift, _ in middle)
                (asked if moved else own).add(_key(span, number, "".join([ends, *(x for _, x in middle)])))
    return [k * 2 for k in own] + [k * 2 + 1 for k in asked - own]


def _scattered(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _least(line: np.ndarray, at: np.ndarray, hashes: np.ndarray, n: int, size: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``n`` lines whose grams come by (line, hash): the hash with which ``edits + 1`` are apart; if so many are."""
    first = np.searchsorted(line, np.arange(n + 1))
    count = np.diff(first)
    chosen, n_chosen, last = np.full((edits + 1, n), -(1 << 60)), np.zeros(n, np.int64), np.zeros(n, np.uint64)
    now, rank = np.flatnonzero(count), 0
    while len(now):
        spots = first[now] + rank
        apart = (np.abs(chosen[:, now] - at[spots]) >= size).all(axis=0)
        found, spots = now[apart], spots[apart]
        chosen[n_chosen[found], found] = at[spots]
        last[found] = hashes[spots]
        n_chosen[found] += 1
        rank += 1
        now = now[(n_chosen[now] <= edits) & (count[now] > rank)]
    return last, n_chosen > edits


def gram_keys(codes: np.ndarray, n: np.ndarray, ahead: int, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the line, key) by grams, for the range of lengths that ``ahead`` more characters are in.

    ``codes`` are the characters of lines of ``n`` characters, one after another, the longer lines last.
    """
    part = (n + ahead) // RANGE
    starts = np.concatenate([[0], np.cumsum(n)])
    # a gram's hash is a difference of running sums, moved back to the start
    most = max(PIECE, BATCH, len(codes))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * _powers(BASE, most)[:len(codes)])])
    back = _powers(pow(BASE, -1, 1 << 64), most)
    # the shortest line with keys of this range, which lacks ``edits`` characters, still has room for all
    sizes = np.where(part * RANGE >= GRAMS_FROM, np.minimum(GRAM, part * RANGE // (2 * edits + 1)), 0)
    lines, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for size in np.unique(sizes[sizes > 0]).tolist():
        low, high = np.searchsorted(sizes, [size, size + 1])
        begin, stop = starts[low], starts[high] + 1 - size
        hashes = (sums[begin + size:stop + size] - sums[begin:stop]) * back[begin:stop]
        # few grams of a line have the least hashes; a line in which they lie too close has all its grams looked at
        share = FEW / (n[low] - size + 1)
        spots = begin + (np.flatnonzero(hashes < np.uint64(int(share * (1 << 64)))) if share < 1 else np.arange(stop - begin))
        line = np.searchsorted(starts, spots, "right") - 1
        while True:
            fits = spots + size <= starts[line + 1]
            line, spots = line[fits], spots[fits]
            at, value = spots - starts[line], hashes[spots - begin]
            order = np.lexsort((value, line))
            line, at, value = line[order], at[order], value[order]
            last, done = _least(line - low, at, value, high - low, size, edits)
            if share >= 1:
                # a line that repeats itself may run out of grams: then it gives them all
                last[~done] = (1 << 64) - 1
                done[:] = True
            given = done[line - low] & (value <= last[line - low])
            line, at, value = line[given], at[given], value[given]
            for shift in {0, edits}:
                # a copy has the gram at most ``edits`` places off
                place = (at + shift) // PLACES
                far = np.flatnonzero(place != at // PLACES) if shift else slice(None)
                where = (part[line[far]] | place[far] << 32).astype(np.uint64)
                lines.append(line[far])
                keys.append(_scattered(_scattered(value[far]) + where * np.uint64(BASE)))
            if done.all():
                break
            left, share = low + np.flatnonzero(~done), 1
            line = np.repeat(left, n[left])
            spots = np.arange(len(line)) + np.repeat(starts[left] - np.cumsum(n[left]) + n[left], n[left])
    return np.concatenate(lines), (np.concatenate(keys) >> np.uint64(1) << np.uint64(1)).view(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _counts(codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How often characters of each of 16 kinds are in each line."""
    kind = codes * np.uint64(BASE)
    kind >>= np.uint64(60)
    kind |= np.repeat(np.arange(len(n), dtype=np.uint64) * np.uint64(LANES), n)
    return np.bincount(kind.view(np.int64), minlength=len(n) * LANES).reshape(-1, LANES)


def _described(lines: list[str], edits: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Length, counts of characters (modulo 16, in one number) and keys of lines; about ``BATCH`` characters at a time."""
    n = np.fromiter(map(len, lines), np.int64, len(lines))
    counts, owners, keys = np.zeros((len(lines), LANES), np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in np.flatnonzero(n >= PIECE):
        for at in range(0, n[i], PIECE):
            part = _codes(lines[i][at:at + PIECE])
            counts[i] += _counts(part, np.array([len(part)]))[0]
    for ahead in sorted({0, edits}):
        # a line near the end of its range of lengths has keys for the next one also
        who = np.flatnonzero((n < PIECE) & (((n + ahead) // RANGE != n // RANGE) | (ahead == 0)))
        who = who[np.argsort(n[who], kind="stable")]
        ends, start = np.cumsum(n[who]), 0
        while start < len(who):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - n[who[start]] + BATCH, "right")))
            batch = who[start:stop]
            codes = _codes("".join([lines[i] for i in batch.tolist()]))
            if not ahead:
                counts[batch] = _counts(codes, n[batch])
            line, key = gram_keys(codes, n[batch], ahead, edits)
            owners.append(batch[line])
            keys.append(key)
            start = stop
    # lines too long for grams at once have segments, too, and so has what may be a copy of one
    more = [(i, k) for i in np.flatnonzero((n < GRAMS_FROM) | (n + edits >= PIECE)) for k in short_keys(lines[i], edits)]
    more = np.array(more, np.int64).reshape(-1, 2)
    line, key = np.concatenate([*owners, more[:, 0]]), np.concatenate([*keys, more[:, 1]])
    order = np.lexsort((key, line))
    line, key = line[order], key[order]
    once = np.concatenate([[True], (line[1:] != line[:-1]) | (key[1:] != key[:-1])])[:len(line)]
    ends = np.concatenate([[0], np.cumsum(np.bincount(line[once], minlength=len(lines)))]).astype(np.int32)
    packed = (counts % 16).astype(np.uint64) << (np.arange(LANES, dtype=np.uint64) * np.uint64(4))
    return n, np.bitwise_or.reduce(packed, axis=1).view(np.int64), pa.ListArray.from_arrays(pa.array(ends), pa.array(key[once]))


def _documents(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    """Per document its lines as (h, size, counts, keys)."""
    for batch in small_batches(batches, "text", 1 << 20):
        found = [lines_of(t) for t in batch.column("text").to_pylist()]
        lines = [x for of_doc in found for x in of_doc]
        size, counts, keys = _described(lines, edits)
        hashes = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]
        described = pa.StructArray.from_arrays(
            [pa.array(hashes, pa.binary()), pa.array(size.astype(np.int32)), pa.array(counts), keys],
            names=["h", "size", "counts", "keys"])
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("row"), pa.ListArray.from_arrays(pa.array(ends), described)],
            names=["doc", "row", "lines"])


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        ids, lines = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            found = lines_of(text)
            ids += [w["id"] for w in wanted]
            lines += [found[w["number"]] for w in wanted]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.string())], names=["id", "line"])


def _joint(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "line", 1 << 20):
        keys = [joint_keys(x, edits) for x in batch.column("line").to_pylist()]
        at = pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), pa.array([k for of_line in keys for k in of_line], pa.int64())], names=["id", "key"])


def _possible(edits: int) -> str:
    """Whether lengths and counts of characters of lines a and b are as near as edits leave them."""
    # a byte for every other count: a difference modulo 16, then the lesser of it and its negative; in few operations,
    # as they are what a join spends its time on
    def apart(shift: int) -> str:
        a, b = (f"(shiftrightunsigned({x}_counts, {shift}) & {0x0F0F0F0F0F0F0F0F})" for x in "ab")
        less = f"((({a} | {0x1010101010101010}) - {b}) & {0x0F0F0F0F0F0F0F0F})"
        large = f"(shiftright({less}, 3) & {0x0101010101010101})"
        return f"(({less} ^ (shiftleft({large}, 4) - {large})) + {large})"

    # the bytes' sum is what 255 leaves; an edit takes one character and gives one at most
    return f"abs(a_size - b_size) <= {edits} AND ({apart(0)} + {apart(4)}) % 255 <= {2 * edits}"


def _verified(batches: Iterator[pa.RecordBatch], edits: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "a_line"):
        keep = [within(a, b, edits) for a, b in zip(batch.column("a_line").to_pylist(), batch.column("b_line").to_pylist())]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _shared(keys: DataFrame) -> DataFrame:
    """Rows (id, key) whose key another line has, one of them as its own: with ``index`` (its own) and ``n`` (lines)."""
    keys = keys.select("id", F.shiftright("key", 1).alias("key"), (F.col("key").bitwiseAND(F.lit(1)) == 0).alias("index"))
    # most keys are one line's alone; the rest is small
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("index").alias("indexed"))
    return stored(keys.join(counted.where("n > 1 AND indexed").drop("indexed").hint("merge"), "key"), "met")


def _pairs(owner: DataFrame, other: DataFrame, where: str, edits: int) -> DataFrame:
    """Pairs (a, b) of possible near copies among lines with a key in common; ``where`` names columns as a_ and b_."""
    sides = [
        side.select("key", *(F.col(c).alias(x if c == "id" else f"{x}_{c}") for c in side.columns if c != "key"))
        for side, x in ((owner, "a"), (other, "b"))]
    met = sides[0].join(sides[1].hint("merge"), "key").where(f"({where}) AND {_possible(edits)}")
    return stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")


def line_classes(lines: DataFrame, texts: Callable[[DataFrame], DataFrame], edits: int = EDITS) -> DataFrame:
    """(id, component) of the stored distinct lines (id, size, counts, keys) that have a near copy.

    ``texts`` gives (id, line) for a table of ids, which are unique longs.
    """
    known = lines.select("id", "size", "counts")
    met = _shared(lines.select("id", F.explode("keys").alias("key")))
    rare = met.where(F.col("n") <= OFTEN).join(known, "id")
    pairs = _pairs(rare.where("index"), rare, "a < b OR (a > b AND NOT b_index)", edits)
    hot = met.where(F.col("n") > OFTEN).select("id").distinct()
    needed = stored(texts(pairs.select(F.explode(F.array("a", "b")).alias("id")).union(hot).distinct()), "lines")

    def verified(pairs: DataFrame) -> DataFrame:
        with_texts = (
            pairs.join(needed.withColumnsRenamed({"id": "a", "line": "a_line"}), "a")
            .join(needed.withColumnsRenamed({"id": "b", "line": "b_line"}), "b"))
        return stored(with_texts.mapInArrow(lambda b: _verified(b, edits), "a long, b long"), "links")

    links = verified(pairs)
    if hot.limit(1).count():
        of_hot = needed.join(hot, "id", "left_semi").mapInArrow(lambda b: _joint(b, edits), "id long, key long")
        of_hot = stored(of_hot, "joint_keys")
        joint = stored(_shared(of_hot).join(known, "id"), "joint")
        leaders = joint.groupBy("key").agg(F.min(F.struct("id", "size", "counts")).alias("first")).select("key", "first.*")
        links = links.union(verified(_pairs(leaders, joint, "a <> b", edits)))
        labels = components(links).withColumnRenamed("node", "id")
        labelled = stored(joint.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop(
            "component"), "labelled")
        links = links.union(verified(_pairs(labelled.where("index"), labelled, "a_label <> b_label", edits)))
        forget(of_hot, joint, labelled)
    forget(met, pairs, needed)
    return components(links).withColumnRenamed("node", "id")


def line_dedup(docs: DataFrame, edits: int = EDITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Occurrences that go (doc, row, number, h) with their line's class, documents' counts of lines, documents' texts."""
    narrow = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    narrow = narrow.withColumn("row", F.xxhash64("text"))
    schema = "doc long, row long, lines array<struct<h: binary, size: int, counts: long, keys: array<long>>>"
    found = stored(narrow.mapInArrow(lambda b: _documents(b, edits), schema), "documents")
    place = F.struct("doc", "row", "number")
    distinct = stored(
        found.select("doc", "row", F.posexplode("lines").alias("number", "line"))
        .groupBy(F.col("line.h").alias("h"))
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("line").alias("line"))
        .select("h", "first", "n", "line.size", "line.counts", "line.keys")
        .withColumn("id", F.monotonically_increasing_id()), "lines")

    def texts(ids: DataFrame) -> DataFrame:
        wanted = distinct.select("id", "first.*").join(ids, "id").groupBy("doc", "row").agg(
            F.collect_list(F.struct("id", "number")).alias("wanted"))
        once = narrow.join(wanted, ["doc", "row"]).dropDuplicates(["doc", "row"])
        return once.select("text", "wanted").mapInArrow(_wanted, "id long, line string")

    classes = line_classes(distinct.select("id", "size", "counts", "keys"), texts, edits)
    grouped = stored(distinct.select("id", "h", "first", "n").join(classes, "id", "left").select(
        "h", "first", "n", F.coalesce("component", "id").alias("class")), "classes")
    keepers = grouped.groupBy("class").agg(F.min("first").alias("keep"), F.sum("n").alias("size"))
    # only lines of classes with more than one occurrence lose any
    repeated = grouped.join(keepers.where("size > 1"), "class").select("h", "class", "keep")
    occurrences = found.select("doc", "row", F.posexplode("lines.h").alias("number", "h"))
    marked = occurrences.join(repeated, "h").where(place != F.col("keep"))
    return marked, found.select("doc", "row", F.size("lines").cast("long").alias("n_lines")), narrow


def removed_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Occurrences that go: doc_id, number (among the document's lines with a visible character), class."""
    marked, _, _ = line_dedup(docs, edits)
    return marked.select(F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), "number", "class")


def removal_counts(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, removed (their numbers, comma-joined); texts are not moved."""
    marked, counted, _ = line_dedup(docs, edits)
    gone = marked.groupBy("doc", "row").agg(F.sort_array(F.collect_set("number")).alias("gone"))
    return counted.join(gone, ["doc", "row"], "left").select(
        F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed"))


def without_repeated_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_text (the lines that stay, trimmed, one a line)."""
    marked, _, narrow = line_dedup(docs, edits)
    gone = marked.groupBy("doc").agg(F.collect_set(F.struct("row", "number")).alias("gone"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            n, removed, kept = [], [], []
            for row, text, spots in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "gone"))):
                drop = {s["number"] for s in spots or () if s["row"] == row}
                found = lines_of(text)
                n.append(len(found))
                removed.append(len(drop))
                kept.append("\n".join(x for k, x in enumerate(found) if k not in drop))
            ids = batch.column("doc").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([None if d == LAST_ID else d for d in ids], pa.int64()),
                "n_lines": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string())})

    return narrow.join(gone, "doc", "left").select("doc", "row", "text", "gone").mapInArrow(
        keep, "doc_id long, n_lines long, n_removed long, kept_text string")
