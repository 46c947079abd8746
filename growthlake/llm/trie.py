"""The trie of conversation prefixes, as a table of nodes with counts.

A prefix digest is the XOR of one hash per turn, salted with the turn's depth:
running digests of a conversation of any length add up over blocks of it, and a
node's parent is its digest without its last turn. Digests that share a value
are checked to share parent, depth and content, which by induction makes equal
digests equal prefixes; else the trie is built anew with another salt.

A node belongs to the least conversation through it, so the nodes of one are a
chain that ends with it. Chains, in segments of bounded length, are dealt to
shards. A shard gives each digest a slot by a minimal perfect hash, looks keys
up in it (and compares what stands in the slot), scatters what is attached into
flat arrays, and adds up along the array of parent slots, deepest nodes first.
What hangs below a chain in other shards comes from pointer doubling over the
chains: logarithmically many rounds, each a pre-aggregated shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.llm.common import changes, ranked, stored

GIVEN = 6  # a conversation takes fewer turns than this from the first of its hundred
HUNDRED = 100
RUN = 1024  # turns of a conversation whose digests are added up in one window
SEGMENT = 4096  # nodes of a chain in one shard
SHARD = 8192  # nodes of a shard, on average
ATTEMPTS = 8


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = a ^ (b * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    for shift in (32, 29, 32):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys of two words.

    On each level the keys left over meet twice as many places; those alone in
    theirs stay, numbered in order of their places. ``find`` compares keys, so a
    key that has no slot is told apart.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, n = np.arange(len(a)), 0
        while len(left):
            if len(self._levels) == 64:
                raise ValueError("keys of a perfect hash must be distinct")
            at = self._place(a[left], b[left], len(self._levels), 2 * len(left))
            count = np.bincount(at, minlength=2 * len(left))
            alone = count == 1
            self._levels.append((alone, n + np.cumsum(alone) - 1))
            n += int(alone.sum())
            left = left[~alone[at]]
        self._a, self._b = np.empty_like(a), np.empty_like(b)
        slots = self._slots(a, b)
        self._a[slots], self._b[slots] = a, b

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        return (_mix(a, b, level) % np.uint64(size)).astype(np.int64)

    def _slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (alone, number) in enumerate(self._levels):
            at = self._place(a[todo], b[todo], level, len(alone))
            here = alone[at]
            out[todo[here]] = number[at[here]]
            todo = todo[~here]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where it has none."""
        slots = self._slots(a, b)
        if len(self._a):
            wrong = (self._a[slots] != a) | (self._b[slots] != b)
            slots[wrong] = -1
        return slots


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def rebuilt(conversations: DataFrame, salt: int = 0) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, length) and their rebuilt turns, with digest (a, b) and parent's digest (pa, pb)."""
    def content(lane: str) -> Column:
        return F.xxhash64(F.lit(f"{lane}{salt}"), "role", "text")

    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    hashed = turns.select(
        "*", F.char_length("text").cast("long").alias("size"), *(content(x).alias(f"content_{x}") for x in "abc"))
    placed = ranked(hashed, ["conv_id"], ["turn", "role", "text"], "place", drop=("turn", "role", "text"))

    def lanes(depth: Column) -> list[Column]:
        return [F.xxhash64(depth, f"content_{x}").alias(f"term_{x}") for x in "ab"]

    own = placed.groupBy("conv_id").agg((F.max("place") + 1).alias("n_own"))
    # the first turns of the conversations that others may begin with, a handful each
    first = placed.where((F.col("place") < GIVEN - 1) & (F.col("conv_id") % HUNDRED == 0))
    first = first.withColumn("depth", F.col("place") + 1).select("*", *lanes(F.col("depth")))
    upto = Window.partitionBy("conv_id").orderBy("place")
    first = stored(first.select(
        F.col("conv_id").alias("base"), "depth", "size", "content_c", "term_a", "term_b",
        *(F.bit_xor(f"term_{x}").over(upto).alias(x) for x in "ab")), "first")
    n_first = first.groupBy("base").agg(F.max("depth").alias("n_first"))
    convs = (
        own.withColumn("base", F.col("conv_id") - F.col("conv_id") % HUNDRED)
        .withColumn("skipped", F.crc32(F.col("conv_id").cast("string")) % GIVEN)
        .join(n_first, "base", "left")
        .withColumn("given", F.least("skipped", F.coalesce("n_first", F.lit(0))))
        .withColumn("length", F.col("given") + F.greatest(F.col("n_own") - F.col("skipped"), F.lit(0)))
        .join(first.select("base", F.col("depth").alias("given"), F.col("a").alias("from_a"), F.col("b").alias("from_b")),
              ["base", "given"], "left"))
    convs = stored(convs.select(
        "conv_id", "base", "skipped", "given", "length", *(F.coalesce(f"from_{x}", F.lit(0)).alias(f"from_{x}") for x in "ab")),
        "conversations")

    borrowed = convs.join(first, "base").where("depth <= given")
    mine = placed.join(convs, "conv_id").where("place >= skipped").withColumn(
        "depth", F.col("given") + F.col("place") - F.col("skipped") + 1)
    mine = mine.select("*", *lanes(F.col("depth")), F.floor(F.col("place") / RUN).alias("run"))
    in_run = Window.partitionBy("conv_id", "run").orderBy("place")
    mine = stored(mine.select(
        "conv_id", "depth", "size", "content_c", "length", "run", "term_a", "term_b",
        *(_xor(F.col(f"from_{x}"), F.bit_xor(f"term_{x}").over(in_run)).alias(x) for x in "ab")), "turns")
    # one row per 1024 turns; only conversations of several runs need what went before
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        mine.groupBy("conv_id", "run").agg(*(F.bit_xor(f"term_{x}").alias(x) for x in "ab"))
        .select("conv_id", "run", *(F.bit_xor(x).over(earlier).alias(f"before_{x}") for x in "ab")).where("run > 0"))
    mine = mine.join(before, ["conv_id", "run"], "left").select(
        *(c for c in mine.columns if c not in ("a", "b")),
        *(_xor(F.col(x), F.coalesce(f"before_{x}", F.lit(0))).alias(x) for x in "ab"))
    columns = ["conv_id", "depth", "length", "size", "content_c", "a", "b"]
    both = borrowed.select(*columns, "term_a", "term_b").union(mine.select(*columns, "term_a", "term_b"))
    parents = (_xor(F.col(x), F.col(f"term_{x}")).alias(f"p{x}") for x in "ab")
    return convs, stored(both.select(*columns, *parents), "members")


def prefix_nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The nodes by digest, the ends (a, b, conv_id) and the number of nodes; digests are verified."""
    for salt in range(ATTEMPTS):
        convs, members = rebuilt(conversations, salt)
        alike = ["pa", "pb", "depth", "content_c"]
        found = members.groupBy("a", "b").agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"),
            *(F.min(c).alias(c) for c in alike), *(F.max(c).alias(f"max_{c}") for c in alike))
        clash = F.expr(" OR ".join(f"{c} <> max_{c}" for c in alike) + " OR (a = 0 AND b = 0)")
        root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
        zero = F.lit(0).cast("long")
        root = root.select(
            zero.alias("a"), zero.alias("b"), "n_convs", "conv_id", zero.alias("size"), zero.alias("pa"), zero.alias("pb"),
            zero.alias("depth"), F.lit(False).alias("clash"))
        nodes = stored(found.select(*root.columns[:-1], clash.alias("clash")).union(root), "prefixes")
        n, clashes = nodes.agg(F.count(F.lit(1)), F.coalesce(F.count_if("clash"), F.lit(0))).first()
        if not clashes:
            turnless = convs.where("length = 0").select(zero.alias("a"), zero.alias("b"), "conv_id")
            return nodes.drop("clash"), members.where("depth = length").select("a", "b", "conv_id").union(turnless), n
    raise RuntimeError(f"prefix digests clash under {ATTEMPTS} salts")


def below_chains(chains: DataFrame) -> DataFrame:
    """Chains (conv_id, segment, up_conv, up_segment, leaves, saved), with leaves and saved of all below added.

    After k rounds a chain has the sums of what is fewer than 2^k links below it
    and points 2^k links up; null at the top.
    """
    state = chains
    while state.where("up_conv IS NOT NULL").limit(1).count():
        added = state.where("up_conv IS NOT NULL").groupBy(
            F.col("up_conv").alias("conv_id"), F.col("up_segment").alias("segment")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = state.where("up_conv IS NOT NULL").select(
            F.col("conv_id").alias("up_conv"), F.col("segment").alias("up_segment"),
            F.col("up_conv").alias("next_conv"), F.col("up_segment").alias("next_segment"))
        state = stored(
            state.join(added, ["conv_id", "segment"], "left").join(further, ["up_conv", "up_segment"], "left").select(
                "conv_id", "segment", F.col("next_conv").alias("up_conv"), F.col("next_segment").alias("up_segment"),
                *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved"))), "chains")
    return state.drop("up_conv", "up_segment")


NODE, ATTACHED, HEAD = 0, 1, 2


def accumulate(shard: pa.Table, segment: int) -> pa.Table:
    """The nodes of a shard with leaves and saved of their subtrees, and the conversation of their parent."""
    kind = shard.column("kind").to_numpy()
    column = {c: shard.column(c).to_numpy() for c in shard.column_names}
    key = {c: column[c].view(np.uint64) for c in ("a", "b", "pa", "pb")}
    nodes, attached, heads = (np.flatnonzero(kind == k) for k in (NODE, ATTACHED, HEAD))
    table = PerfectHash(key["a"][nodes], key["b"][nodes])
    slot = table.find(key["a"][nodes], key["b"][nodes])
    n = len(nodes)

    def flat(values: np.ndarray) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[slot] = values[nodes]
        return out

    conv, depth, leaves, saved = (flat(column[c]) for c in ("conv_id", "depth", "leaves", "saved"))
    parent = np.empty(n, np.int64)
    parent[slot] = table.find(key["pa"][nodes], key["pb"][nodes])
    # what other chains bring is attached below, so only links along a chain's segment count here
    same = (conv[parent] == conv) & (depth[parent] // segment == depth // segment) & (depth[parent] == depth - 1)
    parent[~same] = -1
    at = table.find(key["a"][attached], key["b"][attached])
    np.add.at(leaves, at, column["leaves"][attached])
    np.add.at(saved, at, column["saved"][attached])
    over = conv.copy()
    over[table.find(key["a"][heads], key["b"][heads])] = column["conv_id"][heads]
    deepest_first = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[deepest_first])) + 1
    for level in np.split(deepest_first, cuts):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    top = depth[slot] == 0
    return pa.table({
        "a": column["a"][nodes], "b": column["b"][nodes], "conv_id": conv[slot], "depth": depth[slot],
        "parent_conv_id": pa.array(over[slot], pa.int64(), mask=top),
        "n_convs": column["n_convs"][nodes], "n_children": column["n_children"][nodes],
        "n_leaves": leaves[slot], "saved_tokens": saved[slot]})


def end_hashes(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): the hash of a node's ends, ascending and comma-joined.

    Sorted ranges make texts of a batch's ids first; then one task hashes a
    node's texts in order, keeping nothing but the hash state.
    """
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                starts = np.flatnonzero(np.concatenate([[True], changes(batch, ["a", "b"])[1:]]))
                ids = batch.column("conv_id").to_pylist()
                stops = [*starts[1:].tolist(), batch.num_rows]
                joined = [",".join(map(str, ids[i:j])) for i, j in zip(starts.tolist(), stops)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(starts)) for c in ("a", "b", "conv_id")), pa.array(joined, pa.string())],
                    names=["a", "b", "conv_id", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            yield out(done)
        if key is not None:
            yield out([(*key, state.hexdigest())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        a, b, digest = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())], names=["a", "b", "ends_sha256"])

    order = ["a", "b", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        texts, "a long, b long, conv_id long, ids string")
    return pieces.repartition("a", "b").sortWithinPartitions(*order).mapInArrow(hashes, "a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Per node of the trie of rebuilt conversations: the columns that the contract of operator 11 names.

    Turns of a conversation come by turn (null first), then role, then text;
    null roles and texts count as empty, repeated rows are turns each. Rows
    without a conversation belong to none and build no node. A conversation
    left without turns is a member of the root. ``conv_id - conv_id % 100`` of a
    negative id takes the remainder's sign from the id. An empty table gives an
    empty result; other columns are ignored.
    """
    nodes, ends, n = prefix_nodes(conversations)
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    n_children = F.coalesce("n_children", F.lit(0))
    nodes = stored(nodes.join(children, ["a", "b"], "left").select(
        *nodes.columns, F.floor(F.col("depth") / SEGMENT).alias("segment"), n_children.alias("n_children"),
        (n_children == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved")), "nodes")
    chains = nodes.groupBy("conv_id", "segment").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.min(F.struct("depth", "a", "b", "pa", "pb")).alias("head"))
    over = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("up_conv"),
                        F.col("segment").alias("up_segment"))
    chains = chains.select("conv_id", "segment", "leaves", "saved", "head.*").join(over, ["pa", "pb"])
    for c in ("up_conv", "up_segment"):
        chains = chains.withColumn(c, F.when(F.col("depth") > 0, F.col(c)))
    chains = stored(chains, "chains")
    whole = below_chains(chains.select("conv_id", "segment", "up_conv", "up_segment", "leaves", "saved"))
    linked = chains.where("depth > 0").drop("leaves", "saved")
    attached = (
        linked.join(whole, ["conv_id", "segment"]).groupBy("pa", "pb", "up_conv", "up_segment")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("up_conv").alias("conv_id"),
                F.col("up_segment").alias("segment"), "leaves", "saved"))

    shards = max(1, -(-n // SHARD))
    shard = F.pmod(F.xxhash64("conv_id", "segment"), F.lit(shards)).alias("shard")
    sums = ["a", "b", "pa", "pb", "conv_id", "depth", "n_convs", "n_children", "leaves", "saved"]

    def dealt(kind: int, rows: DataFrame, conv: str = "conv_id") -> DataFrame:
        values = [(F.col(conv if c == "conv_id" else c) if c in rows.columns else F.lit(0)).cast("long").alias(c) for c in sums]
        return rows.select(shard, F.lit(kind).alias("kind"), *values)

    records = dealt(NODE, nodes).union(dealt(ATTACHED, attached)).union(dealt(HEAD, linked, "up_conv"))
    segment = SEGMENT
    done = records.groupBy("shard").applyInArrow(
        lambda rows: accumulate(rows, segment), "a long, b long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                    "n_leaves long, saved_tokens long")
    hashed = end_hashes(ends)
    return done.join(hashed, ["a", "b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
