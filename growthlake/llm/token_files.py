"""Token ids as binary shard files in ascending order of document id, and reading them back.

Documents are dealt out by ranges of their ids, so shard k holds the ids before
those of shard k + 1, and each task streams its range into one file. Each
attempt of a task writes a file of its own name, which gets its final form by a
move once it is whole; the manifest, committed by Spark, names the files that
count, so repeated tasks and lost executors do no harm.

Cases: null text counts as empty and yields just the end id; null ids come
first; rows with equal ids are all kept, in order of a hash of their text, and
may lie in several shards; an empty table writes no shard; other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growthlake.llm.common import small_batches, stored
from growthlake.llm.pfor import ShardReader, ShardWriter
from growthlake.session import new_folder

END_ID = 0
# a worker remembers the pieces of the present generation and of the one before; a generation ends at this size
GENERATION_PIECES = 400_000
GENERATION_CHARS = 16_000_000
# words encoded as one text
RUN = 1024
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# white space other than the space and the line end
_ODD_SPACES = frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n")


def _regular(piece: str) -> bool:
    return bool(piece) and not piece[0].isspace() and not piece[-1].isspace()


# a piece after a space is named by its text, one after no space by a tuple of its text
Piece = str | tuple[str]


class _Pieces:
    """Pieces by number, with the ids of all in one array."""

    def __init__(self):
        self.number: dict[Piece, int] = {}
        self.ends, self.ids = array("q", [0]), array("I")
        self.chars = 0

    def add(self, pieces: list[Piece], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces))))
        self.ends.frombytes((len(self.ids) + np.cumsum(lengths, dtype=np.int64)).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.chars += sum(len(p) if type(p) is str else len(p[0]) for p in pieces)

    def numbers(self, pieces: list[Piece]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by number, one after the other, and how many each has."""
        ends, ids = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.uint32)
        starts = ends[numbers]
        lengths = ends[numbers + 1] - starts
        return ids[_places(starts, lengths)], lengths

    def full(self) -> bool:
        return len(self.number) >= GENERATION_PIECES or self.chars >= GENERATION_CHARS


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs, one run after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - np.cumsum(lengths) + lengths, lengths)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of the values, each of ``counts`` of them."""
    total, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _joined(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(found), np.uint32), np.array([len(x) // 4 for x in found], np.int64)


class Encoder:
    """Ids of the tokenizers library, with repeated pieces of text encoded once.

    A byte-level pair encoding never merges across a lone space between two
    other characters, nor across a lone line end, nor between letters and a
    stop or comma; so texts are cut there (each piece keeps its space) and the
    ids of the pieces joined. ``split`` False encodes whole texts, for other
    kinds of tokenizers. Texts that name a special token are never cut.
    """

    def __init__(self, path: str, split: bool = True):
        # a task has one core; the library's own threads would only spin
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = split
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # byte-level vocabularies write the space as this letter
        self.after_space = np.zeros(max(vocabulary.values()) + 1, bool)
        self.after_space[[k for token, k in vocabulary.items() if token.startswith("\u0120")]] = True
        self.known, self.before = _Pieces(), _Pieces()
        # texts that can't be cut at every space
        spaces = "".join(f"\\x{{{ord(c):x}}}" for c in sorted(_ODD_SPACES))
        self.odd = "|".join([r"\A\z|\A[ \n]|[ \n]\z|  | \n|\n ", f"[{spaces}]", *map(re.escape, self.special)])

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words after a space, many words a text: a token that begins with a space begins the next word."""
        runs = self._whole(["".join([f" {w}" for w in words[k:k + RUN]]) for k in range(0, len(words), RUN)])
        ids = np.frombuffer(b"".join(runs), np.uint32)
        starts = np.flatnonzero(self.after_space[ids])
        if len(starts) != len(words):
            # not a byte-level vocabulary
            return _joined(self._whole([" " + w for w in words]))
        return ids, np.diff(starts, append=len(ids))

    def _pieces(self, text: str) -> list[str]:
        """The text as pieces, each but the first with the space before it left off."""
        if not self.split or any(s in text for s in self.special):
            return [text]
        pieces = text.split(" ")
        if ("  " in text or " \n" in text or "\n " in text or not _regular(pieces[0]) or not _regular(pieces[-1])
                or not _ODD_SPACES.isdisjoint(text)):
            pieces = _LONE_SPACE.split(text)
        return pieces

    def _cut(self, piece: str) -> list[Piece]:
        """The parts of a piece after a space."""
        if piece.isalpha():
            return [piece]
        if piece[-1] in ".," and piece[:-1].isalpha():
            return [piece[:-1], (piece[-1],)]
        lines = piece.split("\n")
        if not all(map(_regular, lines)):
            return [piece]
        parts: list[Piece] = []
        for number, line in enumerate(lines):
            mark = line[-1] in ".," and line[:-1].isalpha()
            word = line[:-1] if mark else line
            if number:
                parts += [("\n",), (word,)]
            else:
                parts.append(word)
            if mark:
                parts.append((line[-1],))
        return parts

    def _again(self, pieces: set[Piece]) -> set[Piece]:
        """Takes pieces over from the generation before; returns those that neither knows."""
        fresh = pieces.difference(self.known.number)
        again = [p for p in fresh if p in self.before.number]
        self.known.add(again, *self.before.of(self.before.numbers(again)))
        return fresh.difference(again)

    def _learn(self, pieces: set[Piece]) -> None:
        if self.known.full():
            self.before, self.known = self.known, _Pieces()
        fresh = self._again(pieces)
        cut = {p: parts for p in fresh if type(p) is str and len(parts := self._cut(p)) > 1}
        single = fresh.difference(cut).union(self._again({part for parts in cut.values() for part in parts}))
        bare = [p for p in single if type(p) is tuple]
        words = [p for p in single if type(p) is str and (p.isalpha() or p.split() == [p])]
        spaced = [p for p in single.difference(words) if type(p) is str]
        self.known.add(bare, *_joined(self._whole([p for p, in bare])))
        self.known.add(words, *self._run(words))
        self.known.add(spaced, *_joined(self._whole([" " + p for p in spaced])))
        ids, lengths = self.known.of(self.known.numbers([part for parts in cut.values() for part in parts]))
        self.known.add(list(cut), ids, _sums(lengths, np.array([len(x) for x in cut.values()], np.int64)))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each text has."""
        # nothing here refers to itself; looking for such rings would walk all pieces over and over
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(pc.fill_null(texts, ""))
        finally:
            if collects:
                gc.enable()

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, self.odd) if self.split else pa.array([True] * len(texts), pa.bool_())
        # most texts are cut at every space, and their different words looked up once
        lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        words = lists.flatten().dictionary_encode()
        each = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(each) - each
        different = words.dictionary.to_pylist()
        firsts = [(p,) for p in words.take(pa.array(starts)).to_pylist()]
        others: list[Piece] = []
        counts = []
        for text in texts.filter(odd).to_pylist():
            first, *rest = self._pieces(text) if text else [None]
            others += [(first,), *rest] if text else []
            counts.append(len(rest) + bool(text))
        self._learn(set(different).union(firsts, others))
        numbers = self.known.numbers(different)[words.indices.to_numpy()]
        numbers[starts] = self.known.numbers(firsts)
        if counts:
            # back to the order of the texts
            is_odd = odd.to_numpy(zero_copy_only=False)
            lengths = np.zeros(len(texts), np.int64)
            begin = lengths.copy()
            lengths[~is_odd], lengths[is_odd] = each, counts
            begin[~is_odd], begin[is_odd] = starts, len(numbers) + np.cumsum(counts) - counts
            numbers = np.concatenate([numbers, self.known.numbers(others)])[_places(begin, lengths)]
            each = lengths
        ids, lengths = self.known.of(numbers)
        return ids, _sums(lengths, each)

    def rest(self) -> None:
        """Between tasks a worker holds one generation only."""
        self.before = _Pieces()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, lengths = self.encode_all(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(lengths))[:-1]]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, split: bool = True) -> Encoder:
    """One per worker process, kept between tasks."""
    if (path, split) not in _ENCODERS:
        _ENCODERS[(path, split)] = Encoder(path, split)
    return _ENCODERS[(path, split)]


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes local URIs as file:/path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, split: bool = True) -> DataFrame:
    """Writes ``<folder>/part-NNNNN-<attempt>.pfor``; returns the stored manifest: shard, path, n_docs, n_tokens."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        known = encoder(tokenizer, split)
        writer = out = None
        store, root = _filesystem(folder)
        attempt = f"part-{shard:05d}-{uuid.uuid4().hex}.pfor"
        temporary, whole = f"{root}/_{attempt}", False
        try:
            for batch in small_batches(batches, "text", 4 << 20):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(temporary)
                    writer = ShardWriter(out)
                ids, lengths = known.encode_all(batch.column("text"))
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                writer.add(batch.column("doc_id").to_pylist(), (lengths + 1).tolist(), ids.astype("<u4", copy=False))
            if writer is None:
                return
            writer.close()
            whole = True
            known.rest()
        finally:
            if out is not None:
                out.close()
                if not whole:
                    store.delete_file(temporary)
        store.move(temporary, f"{root}/{attempt}")
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int64()), "path": [f"{folder}/{attempt}"],
            "n_docs": pa.array([writer.count["lengths"]], pa.int64()),
            "n_tokens": pa.array([writer.count["tokens"]], pa.int64())})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = F.asc_nulls_first("doc_id"), F.xxhash64("text")
    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long"), "manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The manifest has a row per file, so its running sum is over few rows. A
    task opens a file at a time and holds one block and one document.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, name = _filesystem(path)
                with store.open_input_file(name) as source:
                    rows: list[tuple] = []
                    for doc_id, ids in ShardReader(source, source.size()).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    yield _rows(rows)

    tasks = max(1, manifest.count())
    return placed.select("path", "start", "shard").repartitionByRange(tasks, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=names)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the shards to a new shared folder and reads their documents back."""
    return read_shards(write_shards(docs, new_folder(docs.sparkSession, "tokens"), tokenizer, end_id))
