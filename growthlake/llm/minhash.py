"""Near-duplicate documents by bottom-k sketches from one hash function.

Every shingle has one hash; a set's sketch is its ``KEPT`` least values. Sets
are compared in three steps: inverted lists of retained values give the overlaps
of sketches, the sketch of the union (the least values of both together) tells
how similar two sets can be, and full sets decide.

Of the k least values of two sets of the wanted similarity, a number ``least``
is in both: of the least values of their union each is with that chance. For
small sets the bound is certain, for others it fails once in 1e9 pairs at the
limit itself. So a pair is a candidate if the lists it shares, with those that
are left out, can make up that number; and each set may leave out ``least - 1``
of its values, the most frequent ones first. Lists of up to ``OFTEN`` sets give
their pairs. Sets that have more frequent values than they may leave out meet
again in lists of more values, and then of all, where a passage that many texts
share is told apart from a text of which there are many near copies, and a copy
that differs too much from all others by the values it has alone. Only the long
lists of those that are still too frequent are read: first everything is
compared with one member of each list, then pairs of different components whose
frequent values, counted by parts, allow a link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import components, forget, small_batches, stored

SEED = 42
KEPT = 128
LISTED = 64
OFTEN = 32
MEET = 5
PARTS = 64
STARS = 2
TASK_ROWS = 4096
# of so many least values, how many are shared at a similarity of 0.8: binomial tails of 2e-10 and 1e-9
SHARED = {LISTED: 29, KEPT: 73}
Least = Callable[[Column], Column]
NO_VALUE = (1 << 63) - 2
MEMORY = 1 << 20


class _WordHashes(dict):
    """Hashes of the words seen, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def _scattered(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted hashes (of 63 bits) of the distinct runs of n words; of all words if there are fewer; none without words."""
    # lower() of bytes changes A-Z only and split() takes just the six ASCII spaces, as the contract wants
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(each))
    runs = np.full(len(each) - size + 1, size, np.uint64)
    for k in range(size):
        runs = _scattered(runs * np.uint64(0x9E3779B97F4A7C15) + each[k:len(each) - size + 1 + k])
    return np.unique(np.minimum(runs >> np.uint64(1), np.uint64(NO_VALUE - 1)).astype(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, set_key (128 bits of the set), n (its size), sketch (its least values), text_key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in small_batches(batches, "text"):
            sets = [shingle_set(t, shingle, known) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), _lists([s[:KEPT] for s in sets]), batch.column("text_key")],
                names=["doc_id", "set_key", "n", "sketch", "text_key"])

    narrow = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
        F.xxhash64(docs["text"].cast("string")).alias("text_key"))
    return narrow.mapInArrow(run, "doc_id long, set_key binary, n long, sketch array<long>, text_key long")


def full_sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(id, elements): the whole sets of the ``needed`` nodes (id, set_key, text_key)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in small_batches(batches, "text"):
            sets = [shingle_set(t, shingle, known) for t in batch.column("text").to_pylist()]
            right = [xxhash.xxh3_128_digest(s.tobytes()) == k for s, k in zip(sets, batch.column("set_key").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(sets)], names=["id", "elements"]).filter(
                pa.array(right, pa.bool_()))

    texts = docs.where("text IS NOT NULL").select(docs["text"].cast("string").alias("text")).withColumns({
        "text_key": F.xxhash64("text"), "other_key": F.xxhash64(F.lit(1), "text")})
    # one row per node, though its text may stand in many rows; other texts of the same key are told by their set
    once = texts.join(needed.hint("shuffle_merge"), "text_key").dropDuplicates(["id", "other_key"])
    return once.select("id", "set_key", "text").mapInArrow(run, "id long, elements array<long>")


def shared(n: Column, listed: int) -> Column:
    """How many of its ``listed`` least values a set of n shingles has in common with any similar one's, at least.

    A partner has at most n / 4 shingles that the set lacks. Up to four fifths
    of ``listed`` both sets are listed whole; up to ``listed`` the partner's list
    may be cut.
    """
    whole = F.ceil(n * 4 / 5)
    cut = listed - F.floor(n / 4)
    return F.when(n <= listed * 4 // 5, whole).when(n <= listed, F.least(whole, cut)).otherwise(F.lit(SHARED[listed]))


def _fit(a_n: Column, b_n: Column, overlap: Column) -> Column:
    """Whether sets of these sizes are similar enough if they have so many elements in common."""
    return overlap * 9 >= (a_n + b_n) * 4


def _padded(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    out = np.full((len(lengths), KEPT), NO_VALUE, np.int64)
    out[np.arange(KEPT) < lengths[:, None]] = column.values.to_numpy()[ends[0]:ends[-1]]
    return out


def alike_sketches(a: np.ndarray, b: np.ndarray, a_n: np.ndarray, b_n: np.ndarray) -> np.ndarray:
    """Which pairs of sketches may be of sets that are similar enough, by the least values of their union."""
    merged = np.sort(np.concatenate([a, b], axis=1), axis=1)
    twice = np.zeros(merged.shape, bool)
    twice[:, 1:] = (merged[:, 1:] == merged[:, :-1]) & (merged[:, 1:] < NO_VALUE)
    rank = np.cumsum(~twice & (merged < NO_VALUE), axis=1)
    in_both = (twice & (rank <= KEPT)).sum(axis=1)
    # sets that fit into their sketches are compared as they are
    small = np.maximum(a_n, b_n) <= KEPT
    overlap = twice.sum(axis=1)
    return np.where(small, 5 * overlap >= 4 * (a_n + b_n - overlap), in_both >= SHARED[KEPT])


def _beside(pairs: DataFrame, a: DataFrame, b: DataFrame, tasks: int | None) -> DataFrame:
    """The pairs with what is known of both; where they are few, in so many tasks."""
    for x, side in (("a", a), ("b", b)):
        pairs = pairs.join(side.hint("shuffle_merge"), x)
        pairs = pairs if tasks is None else pairs.coalesce(tasks)
    return pairs


def by_sketch(pairs: DataFrame, nodes: DataFrame, tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) that their sketches don't rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = alike_sketches(*(_padded(batch.column(f"{x}_sketch")) for x in "ab"),
                                  *(batch.column(f"{x}_n").to_numpy() for x in "ab"))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(x: str) -> DataFrame:
        return nodes.select(F.col("id").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))

    return _beside(pairs, side("a"), side("b"), tasks).mapInArrow(run, "a long, b long")


def by_sets(pairs: DataFrame, sets: DataFrame, tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) whose whole sets have a Jaccard similarity of 0.8 or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 80 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(x: str, elements: str) -> DataFrame:
        return sets.select(F.col("id").alias(x), F.col("elements").alias(elements))

    return _beside(pairs, side("a", "x"), side("b", "y"), tasks).mapInArrow(run, "a long, b long")


def _rare_candidates(lists: DataFrame, whole: bool) -> DataFrame:
    """Pairs that meet in the postings (value, id, n, least, n_out, n_often) as often as similar sets must."""
    member = F.struct("id", "n", "least", "n_out", "n_often")
    lists = lists.groupBy("value").agg(F.sort_array(F.collect_list(member)).alias("members")).where(F.size("members") > 1)
    firsts = lists.select(F.explode("members").alias("first"), "members")

    def later(x: Column) -> Column:
        return (x["id"] > F.col("first.id")) & _fit(x["n"], F.col("first.n"), F.least(x["n"], F.col("first.n")))

    pairs = firsts.select("first", F.explode(F.filter("members", later)).alias("second"))
    met = pairs.groupBy("first", "second").agg(F.count(F.lit(1)).alias("met"))
    both = [(F.col(f"first.{c}"), F.col(f"second.{c}")) for c in ("n", "least", "n_out", "n_often")]
    (a_n, b_n), least, n_out, n_often = both
    # what either leaves out is a prefix of one order, so of the values in both the longer one is missing; whole sets
    # leave out long lists only, which are left out by both
    lost = F.least(*n_often) if whole else F.greatest(*n_out)
    enough = F.col("met") >= F.greatest(F.greatest(*least) - lost, F.lit(1))
    if whole:
        enough = enough & _fit(a_n, b_n, F.col("met") + F.least(*n_often))
    return met.where(enough).select(F.col("first.id").alias("a"), F.col("second.id").alias("b"))


def _tasks(rows: DataFrame) -> int:
    """For so many stored rows: a shuffle may have far more partitions."""
    return -(-rows.count() // TASK_ROWS) or 1


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (id, component) after more links (a, b), which are between components and so fewer than links of nodes."""
    tasks = _tasks(links)
    apart = _labelled(_labelled(links, labels, "a", "a_label").coalesce(tasks), labels, "b", "b_label").coalesce(tasks)
    moved = components(apart.where("a_label <> b_label"), "a_label", "b_label", tasks).select(
        F.col("node").alias("component"), F.col("component").alias("into"))
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).join(labels.hint("shuffle_merge"), "id", "left_anti").coalesce(tasks)
    every = labels.unionByName(ends.distinct().withColumn("component", F.col("id")))
    out = stored(every.join(moved, "component", "left").coalesce(_tasks(labels)).select(
        "id", F.coalesce("into", "component").alias("component")), "joined")
    forget(labels)
    return out


def _labelled(rows: DataFrame, labels: DataFrame, on: str = "id", label: str = "label") -> DataFrame:
    """Rows with the component of a node, itself where it has no link."""
    named = labels.select(F.col("id").alias(on), F.col("component").alias(label))
    return rows.join(named.hint("shuffle_merge"), on, "left").withColumn(label, F.coalesce(label, on))


def _meetings(postings: DataFrame, least: Least, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b) from the lists of the postings (id, n, value), and the nodes with too many frequent values.

    Of a node's values, the most frequent first, as many are left out as leave
    similar sets ``MEET`` in common. Nodes are (id, n, n_often, kept, values):
    values in long lists, how many of them can't be left out, all values that
    other nodes have, least frequent first. Where the postings are of whole
    sets, only long lists are left out, and sets that meet in no short list have
    no more than that in common.
    """
    counts = postings.groupBy("value").agg(F.count(F.lit(1)).alias("n_sets")).where("n_sets > 1")
    met = postings.join(counts.hint("shuffle_merge"), "value")
    values = met.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("n_sets", "value"))).alias("values"))
    values = values.withColumn("least", least(F.col("n")).cast("long")).withColumn(
        "n_often", F.size(F.filter("values", lambda v: v["n_sets"] > OFTEN)).cast("long"))
    values = values.withColumn("n_out", F.col("n_often") if whole else F.greatest("n_often", F.col("least") - MEET))
    # the places of unshared values come after all others
    values = stored(values.withColumn("kept", F.col("n_often") - F.col("least") + 1), "frequent")
    read = F.greatest(F.size("values") - F.col("n_out"), F.lit(0)).cast("int")
    rare = values.select("id", "n", "least", "n_out", "n_often", F.explode(F.slice("values", F.lit(1), read)).alias("v"))
    pairs = stored(_rare_candidates(rare.select("v.value", "id", "n", "least", "n_out", "n_often"), whole), "met")
    too_many = stored(values.where("kept > 0").select("id", "n", "n_often", "kept", "values"), "hot")
    forget(values)
    return pairs, too_many


def long_lists(nodes: DataFrame) -> DataFrame:
    """(value, id, n, n_often, parts): the long lists to read, and how many values of long lists a node has in each part.

    A value's part is a remainder of its hash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frequent = [v.values.to_numpy() for v in batch.column("frequent")]
            parts = [np.bincount(v % PARTS, minlength=PARTS).astype(np.int32) for v in frequent]
            lists = [v[:k] for v, k in zip(frequent, batch.column("kept").to_pylist())]
            ends = pa.array(np.arange(len(parts) + 1, dtype=np.int32) * PARTS)
            counts = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts) if parts else [], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "n", "n_often")), counts, _lists(lists)],
                names=["id", "n", "n_often", "parts", "lists"])

    frequent = F.transform(F.filter("values", lambda v: v["n_sets"] > OFTEN), lambda v: v["value"])
    read = nodes.select("id", "n", "n_often", "kept", frequent.alias("frequent")).mapInArrow(
        run, "id long, n long, n_often long, parts array<int>, lists array<long>")
    return read.select(F.explode("lists").alias("value"), "id", "n", "n_often", "parts")


def set_labels(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(id, component) of every node that is linked, as the links of all pairs connect them."""
    def listed(of: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        postings = of.select("id", "n", F.explode(F.slice("sketch", 1, n)).alias("value"))
        return _meetings(postings, lambda x: shared(x, n))

    def only(of: DataFrame, ids: DataFrame) -> DataFrame:
        return of.join(ids.select("id").hint("shuffle_merge"), "id", "left_semi")

    first, frequent = listed(nodes, LISTED)
    second, still = listed(only(nodes, frequent), KEPT)
    near = stored(by_sketch(first.union(second).distinct(), nodes), "near")
    forget(first, second, frequent)
    needed = near.select(F.explode(F.array("a", "b")).alias("id")).union(still.select("id"))
    sets = stored(full_sets(docs, only(nodes.select("id", "set_key", "text_key"), needed), shingle), "sets")
    # what is too frequent in sketches meets by whole sets, for which the bound is certain
    whole = only(sets, still).select("id", F.size("elements").cast("long").alias("n"), F.explode("elements").alias("value"))
    third, left = _meetings(whole, lambda n: F.ceil(n * 4 / 5), whole=True)
    hot = stored(long_lists(left), "lists")
    links = stored(by_sets(near.union(third).distinct(), sets), "links")
    forget(near, third, still, left)
    labels = stored(components(links, tasks=_tasks(links)).withColumnRenamed("node", "id"), "joined")
    forget(links)
    if hot.limit(1).count():
        ids = hot.select("id").distinct()
        large = stored(only(nodes.select("id", "n", "sketch"), ids), "nodes")
        hot_sets = stored(only(sets, ids), "sets")
        labels = _hot_labels(hot, large, hot_sets, labels)
        forget(large, hot_sets)
    forget(hot, sets)
    return labels


def _overlap(a_parts: Column, b_parts: Column) -> Column:
    """No more values than that are in both: of each part, as many as the set with fewer has."""
    return F.aggregate(F.zip_with(a_parts, b_parts, lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)


def _hot_labels(hot: DataFrame, nodes: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels (id, component) when all nodes of long lists are connected that should be.

    Pairs that share a short list are known already; others have only values of
    long lists in common. Copies of one text lack some of its values, and mostly
    not the same ones, so a pair lacks about as many as both together: the counts
    by parts of the values show it, and rule out copies that are near, but not
    near enough.
    """
    # a turn has no more pairs than there are rows of lists
    tasks = _tasks(hot)
    for turn in range(STARS):
        labelled = _labelled(hot, labels).coalesce(tasks)
        # the centre of a list is one of its largest component: at first the same one in lists of the same sets
        chance = F.xxhash64("id") if turn == 0 else F.xxhash64(F.lit(turn), "value", "id")
        order = F.struct(chance.alias("order"), F.col("id"), F.col("n"), F.col("n_often"), F.col("label"))
        centres = labelled.groupBy("value", "label").agg(F.count(F.lit(1)).alias("size"), F.min(order).alias("centre")).groupBy(
            "value").agg(F.max(F.struct("size", "centre")).alias("top")).select(
            "value", F.col("top.centre.id").alias("a"), *(F.col(f"top.centre.{c}").alias(f"a_{c}") for c in ("n", "n_often", "label")))
        stars = labelled.join(centres.hint("shuffle_merge"), "value").where(
            (F.col("label") != F.col("a_label")) & _fit(F.col("n"), F.col("a_n"), F.least("n_often", "a_n_often")))
        stars = stars.select("a", F.col("id").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        links = stored(by_sets(by_sketch(stars, nodes, tasks), sets, tasks), "links")
        found = links.limit(1).count()
        if found:
            labels = _joined(labels, links)
        forget(links)
        if not found:
            break
    labelled = stored(_labelled(hot, labels).coalesce(tasks), "labelled")
    largest = labelled.groupBy("value", "label").agg(F.count(F.lit(1)).alias("size")).groupBy("value").agg(
        F.max(F.struct("size", "label")).alias("largest")).select("value", "largest.label")
    # of two components one is not the largest of the list
    left, right = (labelled.select("value", *(F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "n_often", "label", "parts")))
                   for x in "ab")
    largest = largest.withColumnRenamed("label", "top").hint("shuffle_merge")
    left = left.join(largest, "value").where("a_label <> top")
    across = left.join(right.hint("shuffle_merge"), "value").where(
        (F.col("a_label") != F.col("b_label")) & ((F.col("b_label") == F.col("top")) | (F.col("a_label") < F.col("b_label")))
        & _fit(F.col("a_n"), F.col("b_n"), F.least("a_n_often", "b_n_often"))
        & _fit(F.col("a_n"), F.col("b_n"), _overlap(F.col("a_parts"), F.col("b_parts"))))
    across = stored(across.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct(), "across")
    tasks = _tasks(across)
    links = stored(by_sets(by_sketch(across, nodes, tasks), sets, tasks), "links")
    if links.limit(1).count():
        labels = _joined(labels, links)
    forget(labelled, across, links)
    return labels


def near_duplicate_sets(docs: DataFrame, shingle: int = 2) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    Links are pairs of documents whose sets of shingles have a Jaccard
    similarity of 0.8 or more. Null and empty texts, and those of white space
    only, have no shingle and are linked with nothing, not even with each other.
    Equal sets are one node, however many documents have them. Rows that share
    an id are documents each; a row without an id takes part in its component,
    which is named by the least id (null if none has one), and is kept only in
    a component without ids. An empty table gives an empty result; other
    columns are ignored.
    """
    sketched = stored(sketches(docs, shingle), "sketches")
    distinct = sketched.where("n > 0").dropDuplicates(["set_key"]).select("set_key", "n", "sketch", "text_key")
    nodes = stored(distinct.withColumn("id", F.monotonically_increasing_id()), "nodes")
    keyed = stored(sketched.select("doc_id", "set_key", "n"), "keyed")
    forget(sketched)
    labels = set_labels(docs, nodes, shingle)
    named = _labelled(nodes.select("id", "set_key"), labels)
    least = keyed.groupBy("set_key").agg(F.min("doc_id").alias("least"))
    named = stored(named.join(least, "set_key"), "named")
    forget(nodes, labels)
    smallest = named.groupBy("label").agg(F.min("least").alias("smallest"))
    classes = named.join(smallest, "label").select("set_key", "smallest")
    return keyed.join(classes.hint("shuffle_merge"), "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
