"""Substring dedup with difference-cover anchors: passages of 50 words or more that an earlier document has too.

Every window need not be hashed to find repeats. For a difference cover D of
the residues modulo v, any two places i and j have a k < v with both i + k and
j + k at residues in D. So when 50 words at i equal those at j, both documents
have an anchor, a run of 50 - v + 1 words at a place of the cover, at the same
distance into the match. Anchors are hashed at the cover's places only (6 of
31); those found in two documents or more are extended: just the windows that
could hold them are hashed in full and compared.

An anchor and a window shrink to their least documents before the shuffle, and
occurrences meet those by a join whose hot keys AQE splits; pairs of documents
are never made. Windows are told apart by 96 bits of two hashes.

Cases: null and empty texts have no words; a document of fewer than 50 words
loses none; of rows with equal doc_id, one text's windows are not earlier than
the other's, and each row gets its own result; null ids count as the largest one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growthlake.llm.common import small_batches

WINDOW = 50
PERIOD = 31
# fixed values: a perfect difference cover of the residues modulo 31
COVER = (0, 1, 3, 8, 12, 18)
LAST_ID = (1 << 63) - 1
# a spot is the number of a row among those of its doc_id, and the word's place below it
ROW_SHIFT = 40
ANCHOR_BITS = 48

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (self._powers(x, size) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = tuple(map(Powers, _BASES))


def split_words(text: str | None) -> list[bytes]:
    # split() of bytes takes just the six ASCII spaces
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], np.uint64)


def window_hashes(hashes: np.ndarray, length: int, places: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each place: a polynomial in the words' hashes, shifted to a common power."""
    up, down = _POWERS[which].upto(len(hashes) + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:len(hashes)], dtype=np.uint64)])
    x = (prefix[places + length] - prefix[places]) * down[places]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def anchor_places(n: int, length: int, cover: tuple[int, ...], period: int) -> np.ndarray:
    """Places of the cover from which ``length`` words follow."""
    starts = np.arange(0, max(0, n - length + 1), period)
    places = np.sort((starts[:, None] + np.array(cover)[None, :]).ravel())
    return places[places + length <= n]


def _rows(batch: pa.RecordBatch, counts: list[int], place: list[np.ndarray], **values: np.ndarray) -> pa.RecordBatch:
    """The batch's ``doc``, each as often as counted, with the spots of the places and other columns."""
    doc = batch.column("doc").take(pa.array(np.repeat(np.arange(len(counts)), counts)))
    row = np.repeat(batch.column("row").to_numpy().astype(np.int64), counts)
    spot = (row << ROW_SHIFT) + _joined(place, np.int64)
    return pa.RecordBatch.from_pydict({"doc": doc, "spot": pa.array(spot)} | {n: pa.array(x) for n, x in values.items()})


def _places(row: int, spots: list[int] | None) -> np.ndarray:
    """Places of the document's row among its spots."""
    spots = np.array(spots or [], np.int64)
    return spots[spots >> ROW_SHIFT == row] & ((1 << ROW_SHIFT) - 1)


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)


def _anchors(batches: Iterator[pa.RecordBatch], length: int, window: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        counts, place, key = [], [], []
        for text in batch.column("text").to_pylist():
            words = split_words(text)
            places = anchor_places(len(words) if len(words) >= window else 0, length, COVER, PERIOD)
            counts.append(len(places))
            if len(places):
                place.append(places)
                # a shorter key is enough for a filter; what it finds too much, the windows sort out
                key.append((window_hashes(word_hashes(words), length, places) >> np.uint64(64 - ANCHOR_BITS)).view(np.int64))
        yield _rows(batch, counts, place, key=_joined(key, np.int64))


def _windows(batches: Iterator[pa.RecordBatch], length: int, window: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows that hold one of the row's repeated anchors."""
    for batch in small_batches(batches, "text", 1 << 20):
        counts, place, keys = [], [], ([], [])
        for text, row, spots in zip(*(batch.column(c).to_pylist() for c in ("text", "row", "spots"))):
            hashes = word_hashes(split_words(text))
            near = _places(row, spots)[:, None] - np.arange(window - length + 1)[None, :]
            places = np.unique(near[(near >= 0) & (near <= len(hashes) - window)])
            counts.append(len(places))
            place.append(places)
            keys[0].append(window_hashes(hashes, window, places, 0).view(np.int64))
            keys[1].append((window_hashes(hashes, window, places, 1) >> np.uint64(32)).astype(np.uint32).view(np.int32))
        yield _rows(batch, counts, place, k1=_joined(keys[0], np.int64), k2=_joined(keys[1], np.int32))


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        n, removed, kept = [], [], []
        for text, row, spots, copy in zip(*(batch.column(c).to_pylist() for c in ("text", "row", "spots", "copy"))):
            words = split_words(text)
            places = _places(row, spots)
            n.append(len(words))
            if copy and len(words) >= window:
                words = []
            elif len(places):
                change = np.zeros(len(words) + 1, np.int32)
                change[places] += 1
                change[places + window] -= 1
                keep = np.cumsum(change[:-1]) == 0
                words = [w for w, k in zip(words, keep.tolist()) if k]
            removed.append(n[-1] - len(words))
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        ids = batch.column("doc").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None if d == LAST_ID else d for d in ids], pa.int64()), pa.array(n, pa.int64()),
             pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (the words that stay, joined by one space).

    A word goes if a window of 50 words that covers it also starts in a document
    with a smaller doc_id, judged on the texts as they came in.

    Texts move once: all steps read the same exchange by document. Exact copies
    of an earlier text lose all their windows and need no anchors.
    """
    length = window - PERIOD + 1
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"), text.alias("text"))
    same_doc = Window.partitionBy("doc").orderBy(F.xxhash64("text"), "text")
    texts = narrow.repartition("doc").withColumn("row", F.row_number().over(same_doc) - 1)

    hashes = narrow.select("doc", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    first = hashes.groupBy("h1", "h2").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    copies = (
        hashes.join(first, ["h1", "h2"]).where("doc > low")
        .groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("copied"))
    )
    is_copy = F.array_contains("copied", F.struct(
        F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")))
    # an outer join, as an anti join would be pushed below the exchange, which then isn't the same any more
    marked = texts.join(copies, "doc", "left").select("doc", "text", "row", F.coalesce(is_copy, F.lit(False)).alias("copy"))

    anchors = marked.where("NOT copy").select("doc", "text", "row").mapInArrow(
        lambda b: _anchors(b, length, window), "doc long, spot long, key long")
    # those of one document alone also count here; the windows will tell
    shared = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    repeated = anchors.join(shared, "key").groupBy("doc").agg(F.collect_set("spot").alias("spots"))
    windows = texts.join(repeated, "doc").select("doc", "text", "row", "spots").mapInArrow(
        lambda b: _windows(b, length, window), "doc long, spot long, k1 long, k2 int")
    earliest = (
        windows.groupBy("k1", "k2").agg(F.min("doc").alias("low"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("k1", "k2", "low")
    )
    later = windows.join(earliest, ["k1", "k2"]).where("doc > low")
    spots = later.groupBy("doc").agg(F.collect_set("spot").alias("spots"))
    return marked.join(spots, "doc", "left").select("doc", "text", "row", "copy", "spots").mapInArrow(
        lambda b: _kept(b, window), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))

