"""Patched frame-of-reference blocks: whole numbers packed at a width that most of a block's values need.

A block subtracts its minimum and packs the rest at the width of a percentile,
the one of ``PERCENTILES`` that gives the fewest bytes. Values that need more
bits keep their low bits there; their places and high bits form the exception
list. A shard file is

    magic | blocks | index | footer

where a block is ``header, packed bits, exception places, exception high bits``
and the index holds the byte at which each block starts. Three streams share a
file: token ids, document lengths and document ids. Reading needs the footer,
the index and the blocks asked for.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
PERCENTILES = (50, 75, 90, 95, 97, 99, 100)
MAGIC = b"PFORv1\0\0"
STREAMS = ("tokens", "lengths", "doc_ids")
_HEADER = struct.Struct("<IqBBI")  # values, minimum, width, bytes of a high part, exceptions
_FOOTER = struct.Struct("<9QQ8s")  # per stream: values, blocks, byte of its index; null ids; magic


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if int(x.max()) < 1 << 53:
        return np.frexp(x.astype(np.float64))[1]
    top = (x >> np.uint64(32)).astype(np.float64)
    return np.where(top > 0, 32 + np.frexp(top)[1], np.frexp((x & np.uint64(0xFFFFFFFF)).astype(np.float64))[1])


def _pack(x: np.ndarray, width: int) -> bytes:
    """Values in 64 lanes of equal length; the bits of lane i start at bit i * width of each column of words."""
    if not width:
        return b""
    lanes = np.zeros((64, -(-len(x) // 64)), np.uint64)
    lanes.ravel()[:len(x)] = x
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return words.tobytes()


def _unpack(data: bytes, n: int, width: int) -> np.ndarray:
    columns = -(-n // 64)
    lanes = np.zeros((64, columns), np.uint64)
    if width:
        words = np.frombuffer(data, "<u8").reshape(width, columns)
        mask = np.uint64((1 << width) - 1)
        for i in range(64):
            word, shift = divmod(i * width, 64)
            lane = words[word] >> np.uint64(shift)
            if shift + width > 64:
                lane = lane | words[word + 1] << np.uint64(64 - shift)
            lanes[i] = lane & mask
    return lanes.ravel()[:n]


def pack_block(values: np.ndarray) -> bytes:
    values = values.astype(np.int64)
    least = int(values.min())
    x = (values - least).view(np.uint64)
    counts = np.bincount(_bits(x), minlength=65)
    upto = np.cumsum(counts)
    most = int(np.flatnonzero(counts)[-1])

    def cost(width: int) -> int:
        high = 2 if most - width <= 16 else 4 if most - width <= 32 else 8
        return len(x) * width + (len(x) - int(upto[width])) * 8 * (2 + high)

    width = min({int(np.searchsorted(upto, len(x) * p / 100)) for p in PERCENTILES}, key=lambda w: (cost(w), w))
    high = 2 if most - width <= 16 else 4 if most - width <= 32 else 8
    wide = np.flatnonzero(x >> np.uint64(width)) if width < 64 else np.zeros(0, np.int64)
    low = x & np.uint64((1 << width) - 1)
    return b"".join((
        _HEADER.pack(len(x), least, width, high, len(wide)), _pack(low, width), wide.astype("<u2").tobytes(),
        (x[wide] >> np.uint64(min(width, 63))).astype(f"<u{high}").tobytes()))


def unpack_block(data: bytes) -> np.ndarray:
    n, least, width, high, wide = _HEADER.unpack_from(data)
    at = _HEADER.size
    packed = -(-n // 64) * 8 * width
    x = _unpack(data[at:at + packed], n, width)
    if wide:
        places = np.frombuffer(data, "<u2", wide, at + packed)
        parts = np.frombuffer(data, f"<u{high}", wide, at + packed + 2 * wide).astype(np.uint64)
        x[places] |= parts << np.uint64(width)
    return x.view(np.int64) + least


class ShardWriter:
    """Writes documents in the order given; holds one block of each stream in memory, and the index."""

    def __init__(self, out):
        self.out, self.at, self.nulls = out, 0, 0
        self.starts: dict[str, list[int]] = {s: [] for s in STREAMS}
        self.count = dict.fromkeys(STREAMS, 0)
        self.waiting: dict[str, list[np.ndarray]] = {s: [] for s in STREAMS}
        self.held = dict.fromkeys(STREAMS, 0)
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _add(self, stream: str, values: np.ndarray, last: bool = False) -> None:
        self.waiting[stream].append(values)
        self.held[stream] += len(values)
        if self.held[stream] < BLOCK and not last:
            return
        x = np.concatenate(self.waiting[stream])
        end = len(x) if last else len(x) - len(x) % BLOCK
        for start in range(0, end, BLOCK):
            self.starts[stream].append(self.at)
            self._write(pack_block(x[start:min(start + BLOCK, end)]))
        self.count[stream] += end
        self.waiting[stream], self.held[stream] = [x[end:]], len(x) - end

    def add(self, doc_ids: list[int | None], lengths: list[int], tokens: np.ndarray) -> None:
        self.nulls += sum(d is None for d in doc_ids)
        self._add("doc_ids", np.array([d or 0 for d in doc_ids], np.int64))
        self._add("lengths", np.array(lengths, np.int64))
        self._add("tokens", tokens)

    def close(self) -> None:
        for stream in STREAMS:
            self._add(stream, np.zeros(0, np.int64), last=True)
        footer = []
        for stream in STREAMS:
            footer += [self.count[stream], len(self.starts[stream]), self.at]
            self._write(np.array(self.starts[stream], "<u8").tobytes())
        self._write(_FOOTER.pack(*footer, self.nulls, MAGIC))


class ShardReader:
    """Random access to the streams of a shard; ``source`` can seek and read."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _FOOTER.size)
        *footer, self.nulls, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.count, self.starts = {}, {}
        first_index = footer[2]
        for k, stream in enumerate(STREAMS):
            self.count[stream], blocks, at = footer[3 * k:3 * k + 3]
            source.seek(at)
            self.starts[stream] = np.frombuffer(source.read(8 * blocks), "<u8")
        every = np.sort(np.concatenate([*self.starts.values(), [first_index]]).astype(np.int64))
        self.end = dict(zip(every[:-1].tolist(), every[1:].tolist()))

    def blocks(self, stream: str, first: int = 0) -> Iterator[np.ndarray]:
        for start in self.starts[stream][first:].tolist():
            self.source.seek(start)
            yield unpack_block(self.source.read(self.end[start] - start))

    def slice(self, stream: str, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop`` of a stream; reads only the blocks that hold them."""
        found, at = [np.zeros(0, np.int64)], start // BLOCK * BLOCK
        for block in self.blocks(stream, start // BLOCK):
            found.append(block[max(start - at, 0):max(stop - at, 0)])
            at += len(block)
            if at >= stop:
                break
        return np.concatenate(found)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document's id and token ids, in the order written; one block of tokens is held at a time."""
        lengths = (n for block in self.blocks("lengths") for n in block.tolist())
        ids = (d for block in self.blocks("doc_ids") for d in block.tolist())
        tokens, held = self.blocks("tokens"), np.zeros(0, np.int64)
        for number, (doc_id, n) in enumerate(zip(ids, lengths)):
            parts = [held]
            have = len(held)
            while have < n:
                parts.append(next(tokens))
                have += len(parts[-1])
            joined = np.concatenate(parts) if len(parts) > 1 else held
            yield None if number < self.nulls else doc_id, joined[:n]
            held = joined[n:]
