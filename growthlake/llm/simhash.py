"""Near-duplicate documents by SimHash fingerprints, found with pivot distance tables.

Fingerprints are compared with fixed reference fingerprints, the pivots. A
table looks at some of the 64 bits and keeps, per fingerprint, its Hamming
distance to every pivot over those bits: its coordinates. Two fingerprints that
agree on the table's bits have a largest coordinate difference of 0 there, so
equal coordinates are an equality join. Each fingerprint's distances to the
pivots over all bits are computed once and stored with it; pairs that meet in a
table are discarded if the largest difference of these coordinates is over the
limit (a Hamming distance is never less), and only the rest is verified.
``pivot_counts`` tells how many pairs that spares.

``exact_tables(limit)`` lose no pair: 64 bits in ``limit + 2`` segments, one
table for every two segments, and at most ``limit`` segments can differ.

Equal fingerprints are one node. Within a table's cell, nodes are first tied to
one of them (a star, no pairs); then only pairs from different components are
looked at, so a large group of near copies never yields all its pairs and no
link between components is lost. Cells are joined by key, so AQE splits a hot one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.llm.common import components, forget, free_names, small_batches, stored

SEED = 42
PIVOTS = 12


def shingle_hashes(text: str | None, n: int) -> np.ndarray:
    """XXH64 of each run of n words, repeats included; of all words if there are fewer; none without words."""
    # lower() of bytes changes A-Z only and split() takes just the six ASCII spaces, as the contract wants
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.array([len(w) + 1 for w in words]))
    stops = (ends[n - 1:] - 1).tolist()
    starts = [0, *ends[:len(stops) - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; as a signed long."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, fingerprint (long), text_key (128 bits of the shingles' hashes, equal for texts of equal words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            hashes = [shingle_hashes(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([fingerprint(h) for h in hashes], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in hashes], pa.binary())],
                names=["doc_id", "fingerprint", "text_key"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fingerprint long, text_key binary")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivots() -> list[int]:
    return [_signed(xxhash.xxh64_intdigest(f"pivot {k}", SEED)) for k in range(PIVOTS)]


def exact_tables(limit: int) -> list[int]:
    """Masks of every two of ``limit + 2`` segments: fingerprints within the limit agree on one of them."""
    parts = limit + 2
    edges = [64 * k // parts for k in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [masks[i] | masks[j] for i in range(parts) for j in range(i)]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def with_coordinates(nodes: DataFrame) -> DataFrame:
    """The nodes with ``at``: the fingerprint ``fp`` and its distances to the pivots, a byte each in two longs."""
    each = [F.shiftleft(_distance(F.col("fp"), F.lit(p)).cast("long"), 8 * (k % 6)) for k, p in enumerate(pivots())]
    low, high = (reduce(lambda x, y: x.bitwiseOR(y), part) for part in (each[:6], each[6:]))
    return nodes.withColumn("at", F.struct("fp", low.alias("low"), high.alias("high"))).drop("fp")


def _apart(a: Column, b: Column) -> Column:
    """The largest difference of two fingerprints' stored coordinates."""
    def coordinate(of: Column, k: int) -> Column:
        return F.shiftrightunsigned(of["low" if k < 6 else "high"], 8 * (k % 6)).bitwiseAND(F.lit(255).cast("long"))

    return F.greatest(*(F.abs(coordinate(a, k) - coordinate(b, k)) for k in range(PIVOTS)))


def _near(a: Column, b: Column, limit: int) -> Column:
    """Largest coordinate difference first, then the distance itself."""
    return (_apart(a, b) <= limit) & (_distance(a["fp"], b["fp"]) <= limit)


def _cells(nodes: DataFrame, tables: list[int]) -> DataFrame:
    """A row per node and table; the cell is a hash of the table and of its coordinates there.

    Spark's size estimate leaves the tables out of account, so joins of cells
    ask for a merge: else a side many times the limit would be broadcast.
    """
    def cell(mask: Column) -> Column:
        return F.xxhash64(mask, *(F.bit_count(F.col("at.fp").bitwiseXOR(F.lit(p)).bitwiseAND(mask)) for p in pivots()))

    masks = F.array(*(F.lit(_signed(m)) for m in tables))
    return nodes.select("*", F.explode(F.transform(masks, cell)).alias("cell"))


def link_components(nodes: DataFrame, tables: list[int], limit: int) -> DataFrame:
    """(node, component) of the stored ``nodes`` (node, fp) that have a link; component is the least node."""
    nodes = stored(with_coordinates(nodes), "coordinates")
    cells = _cells(nodes, tables)
    firsts = (
        cells.groupBy("cell").agg(F.min(F.struct("node", "at")).alias("first"), F.max("node").alias("last"))
        .where("first.node < last").select("cell", F.col("first.node").alias("a"), F.col("first.at").alias("a_at"))
    )
    stars = (
        cells.join(firsts.hint("merge"), "cell").where((F.col("node") != F.col("a")) & _near(F.col("at"), F.col("a_at"), limit))
        .select("a", F.col("node").alias("b")).distinct()
    )
    first = components(stars)
    labelled = stored(
        nodes.join(first, "node", "left").select("node", "at", F.coalesce("component", "node").alias("label")), "nodes")
    forget(nodes)
    across = _across(labelled, tables).where(_near(F.col("a_at"), F.col("b_at"), limit))
    pairs = stored(across.select("a", "b").distinct(), "across")
    by_node = labelled.select("node", "label")
    links = (
        pairs.join(by_node.withColumnsRenamed({"node": "a", "label": "x"}), "a")
        .join(by_node.withColumnsRenamed({"node": "b", "label": "y"}), "b").select("x", "y").distinct()
    )
    second = components(links, "x", "y").withColumnsRenamed({"node": "label", "component": "joined"})
    return labelled.join(second, "label", "left").select(
        "node", F.coalesce("joined", "label").alias("component"))


def _across(labelled: DataFrame, tables: list[int]) -> DataFrame:
    """Pairs (a, a_at, b, b_at) of nodes (node, at, label) that meet in a cell under different labels."""
    cells = _cells(labelled, tables)
    left = cells.select("cell", F.col("node").alias("a"), F.col("at").alias("a_at"), F.col("label").alias("a_label"))
    right = cells.select("cell", F.col("node").alias("b"), F.col("at").alias("b_at"), F.col("label").alias("b_label"))
    return left.join(
        right.hint("merge"), (left["cell"] == right["cell"]) & (F.col("a_label") < F.col("b_label")))


def pivot_counts(nodes: DataFrame, tables: list[int], limit: int) -> DataFrame:
    """One row: ``met`` pairs of ``nodes`` (node, fp) in cells, ``passed`` the coordinates, ``linked`` by distance.

    A pair counts once per cell it meets in. For measuring: this looks at all pairs of each cell.
    """
    met = _across(with_coordinates(nodes).withColumn("label", F.col("node")), tables)
    a, b = F.col("a_at"), F.col("b_at")
    return met.agg(
        F.count(F.lit(1)).alias("met"), F.count_if(_apart(a, b) <= limit).alias("passed"),
        F.count_if(_distance(a["fp"], b["fp"]) <= limit).alias("linked"))


def near_duplicate_classes(docs: DataFrame, shingle: int = 4, limit: int = 4) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links).

    Links are fingerprints at ``limit`` or fewer differing bits. Null and empty
    texts have fingerprint zero and link like any other; repeated rows each get
    a row; null ids get the component of the others (null if all are); an empty
    table gives an empty result; other columns are ignored.
    """
    marked = stored(fingerprints(docs, shingle).select("doc_id", F.col("fingerprint").alias("fp")), "fingerprints")
    nodes = stored(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("node", F.col("fp")), "nodes")
    linked = link_components(nodes.select("node", "fp"), exact_tables(limit), limit)
    classes = nodes.join(linked, "node")
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = stored(classes.join(least, "component").select("fp", "component_id"), "classes")
    return marked.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, shingle: int = 4, limit: int = 4) -> DataFrame:
    """The documents, one of each class of near copies: that with the least id, all columns as they are.

    Classes are those of ``near_duplicate_classes``: fingerprints at ``limit``
    or fewer differing bits. Texts without words have fingerprint zero and are
    one class. Of rows with the same id one stays, and rows without an id stay.
    """
    key, copy = free_names(docs, "node", "copy")
    classes = near_duplicate_classes(docs.where("doc_id IS NOT NULL"), shingle, limit)
    # an id of several texts may be in several classes, and stays if it is the least of one
    kept = classes.where(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias(key)).agg(
        F.count(F.lit(1)).alias(copy))
    mine = docs.withColumn(key, F.col("doc_id").cast("long"))
    met = mine.join(kept.hint("merge"), key)
    once = met.where(F.col(copy) == 1).unionByName(met.where(F.col(copy) > 1).dropDuplicates([key]))
    return once.drop(key, copy).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
