"""Benchmark decontamination with suffix arrays over shards of the training text.

A shard is a slice of one task's documents, bounded in bytes. Its suffix array
holds the positions from which a long enough run of benchmark words starts
(no other suffix can match a test window), ordered by the words that follow.
Every suffix of every test item is looked up by binary search; the range found
is all places of a verbatim match, which are then extended to the longest one.

The test items are a query set against all documents, taken in blocks of at
most ``block_words`` words, so only a bounded block is ever held by the driver
and sent to the tasks. With several blocks, documents get a row key first and
each block is a job of its own, whose finds meet by that key: ids may be null
or repeated.

Cases: null or empty texts have no words, no hits and are clean; an item
without words matches nothing; items of one id are reported once; repeated rows
each get a row; other columns are ignored; an empty benchmark leaves all clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import small_batches, stored

WINDOW = 10
BLOCK_WORDS = 200_000

# letters and digits stay, A-Z become lower case, other ASCII ends a word
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class TestSuffixes:
    """The windows of a block of items, as sorted word numbers."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.ids = [item for item, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        for _, words in items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        starts: dict[bytes, list[tuple[int, int]]] = {}
        self.words = []
        for number, (_, words) in enumerate(items):
            codes = np.array([self.vocabulary[w] for w in words], ">u4")
            self.words.append(codes)
            length = min(window, len(words))
            for at in range(len(words) - length + 1):
                starts.setdefault(codes[at:at + length].tobytes(), []).append((number, at))
        self.places = list(starts.values())
        self.lengths = np.array([len(key) // 4 for key in starts], np.int64)
        width = f"S{4 * window}"
        self.low = np.array([key.ljust(4 * window, b"\0") for key in starts], width)
        self.high = np.array([key.ljust(4 * window, b"\xff") for key in starts], width)
        self.shortest = int(self.lengths.min()) if starts else 0


class Shard:
    """Suffix array over the words of some documents, as numbers in the vocabulary of the test block."""

    def __init__(self, texts: list[str | None], suffixes: TestSuffixes):
        number = suffixes.vocabulary.get
        codes, self.n_words = [], []
        for text in texts:
            words = split_words(text)
            self.n_words.append(len(words))
            codes.extend([number(word, 0) for word in words])
            codes.append(0)
        self.starts = np.concatenate([[0], np.cumsum(np.array(self.n_words, np.int64) + 1)])
        # high bytes first, so that keys compare as bytes like their numbers (concatenate alone would swap them)
        self.codes = np.array(codes + [0] * suffixes.window, ">u4")
        known = self.codes[:len(codes)] > 0
        # words of the vocabulary from each position to the next one that is not in it
        gaps = np.flatnonzero(~known)
        at = np.flatnonzero(known)
        run = gaps[np.searchsorted(gaps, at)] - at
        self.positions = at[run >= suffixes.shortest] if suffixes.shortest else at[:0]
        keys = np.lib.stride_tricks.sliding_window_view(self.codes, suffixes.window)[self.positions]
        self.keys = np.ascontiguousarray(keys).view(f"S{4 * suffixes.window}").ravel()
        order = np.argsort(self.keys, kind="stable")
        self.positions, self.keys = self.positions[order], self.keys[order]

    def find(self, suffixes: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in the array of each test window, the last excluded."""
        low = np.searchsorted(self.keys, suffixes.low, "left")
        return low, np.maximum(low, np.searchsorted(self.keys, suffixes.high, "right"))

    def document_of(self, position: int) -> int:
        return int(np.searchsorted(self.starts, position, "right")) - 1

    def longest(self, position: int, item: np.ndarray, at: int) -> int:
        """Words that agree from the position in the shard and from the place in the item on."""
        a = self.codes[position:position + len(item) - at]
        differ = np.flatnonzero(a != item[at:at + len(a)])
        return int(differ[0]) if len(differ) else len(a)


def _ascending(ids: Iterable[int | None]) -> list[int | None]:
    """Each id once, none first."""
    return sorted(set(ids), key=lambda i: (i is not None, i or 0))


def _search(batches: Iterator[pa.RecordBatch], suffixes: TestSuffixes, spans: bool) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        shard = Shard(batch.column("text").to_pylist(), suffixes)
        low, high = shard.find(suffixes)
        change = np.zeros(len(shard.codes) + 1, np.int32)
        items: dict[int, set[int]] = {}
        longest: dict[tuple[int, int, int], int] = {}
        for window in np.flatnonzero(high > low):
            length = suffixes.lengths[window]
            for position in shard.positions[low[window]:high[window]].tolist():
                change[position] += 1
                change[position + length] -= 1
                document = shard.document_of(position)
                found = items.setdefault(document, set())
                for number, at in suffixes.places[window]:
                    found.add(number)
                    if spans:
                        # a match that also agrees one word earlier is part of a longer one
                        item = suffixes.words[number]
                        if at and position > shard.starts[document] and shard.codes[position - 1] == item[at - 1]:
                            continue
                        first = int(position - shard.starts[document])
                        longest[(document, number, first)] = max(
                            longest.get((document, number, first), 0), shard.longest(position, item, at))
        if spans:
            rows = [(batch.column("doc_id")[d].as_py(), suffixes.ids[i], first, n)
                    for (d, i, first), n in sorted(longest.items())]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
                names=["doc_id", "item_id", "first_word", "n_words"])
            continue
        hit = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
        n_hit = hit[shard.starts[1:] - 1] - hit[shard.starts[:-1]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(shard.n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array([_ascending(suffixes.ids[i] for i in items.get(d, ())) for d in range(batch.num_rows)],
                      pa.list_(pa.int64()))],
            names=["doc_id", "n_words", "n_hit", "items"])


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with words, in order of id, in blocks of at most ``block_words`` words (or one item)."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        words = split_words(row.text)
        if words:
            if block and size + len(words) > block_words:
                yield block
                block, size = [], 0
            block.append((row.item_id, words))
            size += len(words)
    if block:
        yield block


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _first_blocks(benchmark: DataFrame, block_words: int) -> tuple[list, Iterator[list] | None]:
    """The first block, and all of them if there are more."""
    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks, []), next(blocks, None)
    return first, None if second is None else chain([first, second], blocks)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a window of an item), items (ids, ascending).

    With one block this is a single pass without a shuffle. With more, hits of a
    word by several blocks must not count twice, so the spans of all blocks are
    joined by row.
    """
    schema = "doc_id long, n_words long, n_hit long, items array<long>"
    first, blocks = _first_blocks(benchmark, block_words)
    if blocks is None:
        suffixes = TestSuffixes(first, window)
        return _narrow(docs).mapInArrow(lambda batches: _search(batches, suffixes, spans=False), schema)
    return _from_spans(docs, blocks, window)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """Where and how far items run verbatim in documents: doc_id, item_id, first_word, n_words.

    One row for each maximal match of ``window`` words or more (or of a whole
    shorter item); word numbers count from 0 in the document.
    """
    return _spans(_narrow(docs), item_blocks(benchmark, block_words), window)


def _spans(narrow: DataFrame, blocks: Iterator[list], window: int) -> DataFrame:
    """The maximal matches, found and written block by block."""
    schema = "doc_id long, item_id long, first_word long, n_words long"
    found = None
    for block in blocks:
        suffixes = TestSuffixes(block, window)
        part = stored(narrow.mapInArrow(
            lambda batches, suffixes=suffixes: _search(batches, suffixes, spans=True), schema), "spans")
        found = part if found is None else found.union(part)
    return found if found is not None else narrow.sparkSession.createDataFrame([], schema)


def _from_spans(docs: DataFrame, blocks: Iterator[list], window: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = [len(split_words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(words, pa.int64())], names=["row", "doc_id", "n_words"])

    # written, so that each pass sees the same keys
    rows = stored(_narrow(docs).withColumn("row", F.monotonically_increasing_id()), "rows")
    # maximal matches cover just the words that their windows cover
    spans = _spans(rows.select(F.col("row").alias("doc_id"), "text"), blocks, window).withColumnRenamed("doc_id", "row")
    words = spans.select("row", F.explode(F.expr("sequence(first_word, first_word + n_words - 1)")).alias("w"))
    hits = words.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("hit"))
    items = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("item_id")))["item_id"].alias("items"))
    counted = rows.mapInArrow(count, "row long, doc_id long, n_words long")
    return counted.join(hits.join(items, "row"), "row", "left").select(
        "doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any benchmark window, with all their columns; rows are never joined by id."""
    def clean(batches: Iterator[pa.RecordBatch], suffixes: TestSuffixes) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in small_batches(batches, "text"):
            shard = Shard(batch.column("text").to_pylist(), suffixes)
            low, high = shard.find(suffixes)
            keep = np.ones(batch.num_rows, bool)
            for found in np.flatnonzero(high > low):
                positions = shard.positions[low[found]:high[found]]
                keep[np.searchsorted(shard.starts, positions, "right") - 1] = False
            yield batch, keep

    first, blocks = _first_blocks(benchmark, block_words)
    if blocks is None:
        suffixes = TestSuffixes(first, window)
        return docs.mapInArrow(lambda b: (x.filter(pa.array(k)) for x, k in clean(b, suffixes)), docs.schema)
    key = "__row"
    while key in docs.columns:
        key += "_"
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    narrow, gone = rows.select(key, F.col("text").cast("string").alias("text")), None
    for block in blocks:
        suffixes = TestSuffixes(block, window)
        part = stored(narrow.mapInArrow(
            lambda b, suffixes=suffixes: (x.select([key]).filter(pa.array(~k)) for x, k in clean(b, suffixes)),
            f"`{key}` long"), "hit")
        gone = part if gone is None else gone.union(part)
    return rows.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """The result of ``contamination`` with its items as a count and a digest."""
    items = F.array_distinct("items")
    names = F.array_sort(F.transform(items, lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
