"""Merkle manifest of a dataset, with resumable hash states.

Every row is a leaf; per source, runs of three consecutive nodes are hashed to
one until one is left, and the sources' roots likewise. A parent hashes its
children's digests as hex text, 64 bytes each, which is one block of SHA-256. So
its hash state before any child slot is eight words, and can be kept in a table:
a leaf's path holds, per level, the parent's state before the child's slot and
the other children. Folding a replaced leaf resumes that state with the
replacement and the right siblings only; the left ones are never hashed again.
(hashlib can copy such states but not write them, hence the few lines of SHA-256
here, which hash many nodes at once.)

Levels are built ``LEVELS`` at a time: a task gets aligned blocks of
3 ** LEVELS nodes, so a tree of any size takes a few rounds of bounded groups,
and a hot source is many blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import ranked, stored, whole_groups

RUN = 3
LEVELS = 7
BLOCK = RUN ** LEVELS

STEP = np.dtype([("slot", "i1"), ("count", "i1"), ("state", ">u4", 8), ("others", ">u4", (RUN - 1, 8))])


def _cube_root(x: int) -> int:
    low, high = 0, 1 << (x.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= x else (low, middle - 1)
    return low


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]
# of SHA-256: the first 32 bits of the fractions of square and cube roots of primes
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)[:, None]
ROUNDS = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], np.uint32)
HEX = np.array([int.from_bytes(b"%04x" % i) for i in range(1 << 16)], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (8, n) after blocks of 16 words (16, n)."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[i - 7]
                     + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + ROUNDS[i] + w[i]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digests (8, n) as hex text, one block each."""
    out = np.empty((16, digest.shape[1]), np.uint32)
    out[0::2] = HEX[digest >> np.uint32(16)]
    out[1::2] = HEX[digest & np.uint32(0xFFFF)]
    return out


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks."""
    last = np.zeros((16, len(blocks)), np.uint32)
    last[0] = 1 << 31
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last[14], last[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, last)


def _words(column: pa.Array) -> np.ndarray:
    values = b"".join(column.to_pylist())
    return np.ascontiguousarray(np.frombuffer(values, ">u4").reshape(-1, 8).T.astype(np.uint32))


def _binary(words: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(words.T.astype(">u4")).tobytes()
    return pa.Array.from_buffers(pa.binary(32), words.shape[1], [None, pa.py_buffer(data)]).cast(pa.binary())


def _hexes(words: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(words.T.astype(">u4")).tobytes().hex()
    return pa.array([data[i:i + 64] for i in range(0, len(data), 64)], pa.string())


def climb(place: np.ndarray, levels: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps (levels, n) of each node's path and the top (8, n) of its block.

    The nodes of whole blocks come in order; ``place`` is the place in the tree
    and ``levels`` says how many levels the block climbs.
    """
    n = len(place)
    most = int(levels.max(initial=0))
    path = np.zeros((most, n), STEP)
    path["slot"] = -1
    at = np.arange(n)
    for level in range(most):
        up = levels > level
        start = ~up | (place % RUN == 0)
        parent = np.cumsum(start) - 1
        first = np.flatnonzero(start)
        count = np.bincount(parent)
        block = hex_block(digest)
        state = np.repeat(START, len(first), axis=1)
        before = np.zeros((RUN, 8, len(first)), np.uint32)
        for k in range(RUN):
            has = np.flatnonzero((count > k) & up[first])
            before[k][:, has] = state[:, has]
            if len(has):
                state[:, has] = compress(state[:, has], block[:, first[has] + k])
        # a leaf's step: its node's slot, the parent's state before it and the node's siblings
        mine = np.flatnonzero(up[at])
        node = at[mine]
        slot, over = place[node] % RUN, parent[node]
        step = path[level]
        step["slot"][mine], step["count"][mine] = slot, count[over]
        step["state"][mine] = before[slot, :, over]
        for k in range(RUN - 1):
            other = first[over] + k + (k >= slot)
            there = np.flatnonzero(k < count[over] - 1)
            step["others"][mine[there], k] = digest[:, other[there]].T
        rises = np.flatnonzero(up[first])
        above = digest[:, first].copy()
        if len(rises):
            above[:, rises] = finish(state[:, rises], count[rises])
        digest, place, levels, at = above, np.where(up[first], place[first] // RUN, place[first]), levels[first], parent[at]
    return path, digest[:, at]


def fold(digest: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The root that digests (8, n) give along their paths (levels, n), and the hash of each path's siblings."""
    n = digest.shape[1]
    digest = digest.copy()
    proof, proved = np.repeat(START, n, axis=1), np.zeros(n, np.int64)
    for step in path:
        live = np.flatnonzero(step["slot"] >= 0)
        if not len(live):
            continue
        slot, count = step["slot"][live], step["count"][live]
        state = compress(step["state"][live].T.astype(np.uint32), hex_block(digest[:, live]))
        for k in range(RUN - 1):
            there = np.flatnonzero(k < count - 1)
            if not len(there):
                continue
            block = hex_block(step["others"][live[there], k].T.astype(np.uint32))
            proof[:, live[there]] = compress(proof[:, live[there]], block)
            proved[live[there]] += 1
            right = k >= slot[there]
            if right.any():
                state[:, there[right]] = compress(state[:, there[right]], block[:, right])
        digest[:, live] = finish(state, count)
    return digest, finish(proof, proved)


def _climbed(nodes: DataFrame) -> DataFrame:
    """The nodes (tree, place, size of the tree, digest, ...) with the path to the top of their block, and that top."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["tree", "block"]):
            size = batch.column("size").to_numpy()
            levels = sum((size > RUN ** k).astype(np.int64) for k in range(LEVELS))
            path, top = climb(batch.column("place").to_numpy(), levels, _words(batch.column("digest")))
            steps = np.ascontiguousarray(path.T)
            blobs = [steps[i, :k].tobytes() for i, k in enumerate(levels.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blobs, pa.binary()), _binary(top)], names=[*batch.schema.names, "path", "top"])

    blocks = nodes.withColumn("block", F.floor(F.col("place") / BLOCK))
    dealt = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)
    return dealt.mapInArrow(run, f"{schema}, path binary, top binary")


def tree_paths(nodes: DataFrame) -> DataFrame:
    """Nodes (tree, place, size, digest, ...) with their whole path and the root of their tree."""
    rounds = []
    most = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        climbed = stored(_climbed(nodes), "climbed")
        rounds.append(climbed)
        if most <= BLOCK:
            break
        most = ceil(most / BLOCK)
        nodes = climbed.where(F.col("place") % BLOCK == 0).select(
            "tree", F.col("block").alias("place"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("digest"))
    whole = rounds.pop().drop("block").withColumnRenamed("top", "root")
    for lower in reversed(rounds):
        above = whole.select("tree", F.col("place").alias("block"), F.col("path").alias("above"), "root")
        whole = lower.drop("top").join(above, ["tree", "block"]).withColumn("path", F.concat("path", "above")).drop(
            "block", "above")
    return whole


def field(value: Column) -> Column:
    """A value as byte count and text, so that no two rows read alike; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(c) for c in columns)), 256))


def manifest(rows: DataFrame) -> DataFrame:
    """(tree, digest, ...) as rows ranked by (order, digest) in their tree, with the path to the root of all trees.

    Adds ``path``, ``subroot`` and ``root``. The result is a stored table: a
    changed leaf can be folded against it at any later time.
    """
    placed = ranked(rows, ["tree"], ["order", "digest"], "place").drop("order")
    sizes = placed.groupBy("tree").agg((F.max("place") + 1).alias("size"))
    leaves = stored(tree_paths(placed.join(sizes, "tree")).withColumnRenamed("root", "subroot"), "leaves")
    roots = leaves.where("place = 0").select(F.col("tree").alias("name"), F.col("subroot").alias("digest"))
    tops = ranked(roots.withColumn("tree", F.lit("")), ["tree"], ["name"], "place")
    tops = tree_paths(tops.withColumn("size", F.lit(roots.count()).cast("long"))).select(F.col("name").alias("tree"), F.col("path").alias("above"), "root")
    return stored(leaves.join(tops, "tree").withColumn("path", F.concat("path", "above")).drop("above", "size"), "manifest")


def folded(listed: DataFrame, replacement: str) -> DataFrame:
    """The manifest's rows as hex text, with the hash of the siblings and the root that the replaced leaf gives."""
    keep = [c for c in listed.columns if c not in ("tree", "place", "digest", "path", "subroot", "root", replacement)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths: dict[bytes, int] = {}
            which = [paths.setdefault(p, len(paths)) for p in batch.column("path").to_pylist()]
            steps = [np.frombuffer(p, STEP) for p in paths]
            path = np.zeros((len(steps), max((len(s) for s in steps), default=0)), STEP)
            path["slot"] = -1
            for row, s in zip(path, steps):
                row[:len(s)] = s
            given, proof = fold(_words(batch.column(replacement)), path[which].T)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), *(_hexes(_words(batch.column(c))) for c in ("digest", "subroot", "root")),
                 _hexes(proof), _hexes(given)],
                names=[*keep, "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listed.select(*keep).schema)
    out = listed.mapInArrow(run, f"{kept}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaves(docs: DataFrame, tampered: Column, altered: Column) -> DataFrame:
    """A leaf per document, and that of its altered text where ``tampered`` holds."""
    names = ["doc_id", "source", "lang", "n_chars"]
    columns = [docs[c] for c in names]
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        # null first, then by bytes
        F.coalesce(F.concat(F.lit("1"), docs["source"].cast("string")), F.lit("0")).alias("tree"),
        docs["doc_id"].cast("long").alias("order"), leaf([*columns, docs["text"]]).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf([*columns, altered])).otherwise(
            leaf([*columns, docs["text"]])).alias("replaced"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Half of the documents (even crc32 of the id) are altered: their text loses
    its line feeds, and the folded root tells. Null values have a mark of their
    own, so null and empty texts differ; a null text or id is never altered.
    Documents of one id, and those without an id, which come first, are in order
    of their leaves; repeated rows are leaves each. Sources and texts may be of
    any size. An empty table gives an empty result; other columns are ignored.
    """
    tampered = F.crc32(docs["doc_id"].cast("long").cast("string")) % 2 == 0
    altered = F.translate(docs["text"], "\n", "")
    return folded(manifest(document_leaves(docs, tampered, altered)), "replaced")
