"""Mixing sources to target weights by fitting each source's word budget with whole documents.

A source's target is reached by full passes over it and a rest. The rest is a
subset sum: documents are counted by exact size, each size first gives its
share, then a bounded knapsack over the counts closes what is left; which
documents of a size go in follows a seeded order. Only counts by size meet in
one task (one row per size, whatever the number of documents), and documents of
one size are ranked in parts of about ``PART_ROWS``.

The table of sources (one row each) is ranked in a single task.

Cases: null text has size 0 and is taken 0 times; null source is a source of
its own, last in order; a source without words has target 0; documents of equal
size are told apart by the seeded order of id and text; repeated rows are
documents of their own in ``mixture`` and one document in ``mixed``; an empty
table gives an empty result; clashing extra columns are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.llm.common import n_words_of, stored

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17
KNAPSACK_WORDS = 1 << 14
# windows for budgets that a narrower one doesn't meet
WIDER = (1 << 18, 1 << 22)
PART_ROWS = 1024


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source_key, source_size, target from rows of (source, source_key, size).

    Targets are in proportion to the weights up to a level at which they add up
    to the size of all sources; a source that would pass ``cap`` times its own
    size stops there.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_ratio = Window.orderBy("ratio", F.asc_nulls_last("source"))
    sources = (
        sizes.groupBy("source", "source_key").agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("number") % len(weights) + 1))
        .withColumn("most", cap * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        # the level if all sources before this one were full; it holds where this one isn't
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    )
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    return sources.select("source_key", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def fit_budget(sizes: list[int], counts: list[int], budget: int, limit: int = KNAPSACK_WORDS) -> list[int]:
    """Documents to take of each size so that their words add up to the budget, or as near below as found."""
    unit = math.gcd(*sizes) or 1
    sizes, budget = [s // unit for s in sizes], budget // unit
    # the largest documents are exchanged too
    limit = max(limit, 4 * max(sizes, default=0))
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget <= 0 or not total:
        return [0] * len(sizes)
    if budget >= total:
        return list(counts)
    exact = [c * budget / total for c in counts]
    take = [min(c, int(x)) for c, x in zip(counts, exact)]
    left = budget - sum(s * t for s, t in zip(sizes, take))
    # one more of the sizes that lost most by rounding down, then of the largest that fit
    for i in sorted(range(len(sizes)), key=lambda i: (take[i] - exact[i], sizes[i])):
        if take[i] < counts[i] and sizes[i] <= left:
            take[i] += 1
            left -= sizes[i]
    descending = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    for i in descending:
        more = min(counts[i] - take[i], left // sizes[i])
        take[i] += more
        left -= more * sizes[i]
    # a document that isn't taken didn't fit, so what is left is less than the largest size and than each window
    best = take
    for window in (limit, *(w for w in WIDER if w > limit)):
        if not left:
            break
        # give some back, so that the knapsack has something to exchange; all, if a wider window holds the budget
        given, room = list(take), left
        for i in descending:
            back = min(take[i], max(0, window - room) // sizes[i], window // (4 * sizes[i]) + 1)
            if window > limit and budget <= window:
                back = take[i]
            given[i] -= back
            room += back * sizes[i]
        best = max(best, _knapsack(sizes, counts, given, room), key=lambda t: sum(s * n for s, n in zip(sizes, t)))
        if sum(s * n for s, n in zip(sizes, best)) == budget:
            break
    return best


def _knapsack(sizes: list[int], counts: list[int], take: list[int], left: int) -> list[int]:
    """Bounded knapsack over the documents not taken; bit w of ``reach`` says that w words can be made."""
    mask = (1 << (left + 1)) - 1
    steps = []
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
        free, bundle = min(counts[i] - take[i], left // sizes[i]), 1
        while free:
            used = min(bundle, free)
            steps.append((i, used))
            free -= used
            bundle *= 2
    # states are kept at every so many steps and made again in between: they may be long
    every = math.isqrt(len(steps)) + 1
    reach, kept, done = 1, [], 0
    for done, (i, used) in enumerate(steps):
        if done % every == 0:
            kept.append(reach)
        reach |= reach << used * sizes[i] & mask
        if reach >> left & 1:
            break
    best, take = reach.bit_length() - 1, list(take)
    for at in reversed(range(len(kept))):
        part = steps[at * every:min((at + 1) * every, done + 1)]
        states = [kept[at]]
        for i, used in part[:-1]:
            states.append(states[-1] | states[-1] << used * sizes[i] & mask)
        for (i, used), before in zip(reversed(part), reversed(states)):
            if not before >> best & 1:
                take[i] += used
                best -= used * sizes[i]
    return take


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = min(CAP, int(target // size)) if size else 0
    rest = int(round(target)) - passes * size
    take = fit_budget(group["size"].tolist(), group["n"].tolist(), max(rest, 0)) if passes < CAP else [0] * len(group)
    return pd.DataFrame({
        "source_key": group["source_key"], "size": group["size"], "source_size": size, "target": target,
        "passes": np.int64(passes), "extra": np.array(take, np.int64), "parts": -(-group["n"] // PART_ROWS)})


def _plan(rows: DataFrame) -> DataFrame:
    """Copies per row of the stored ``rows`` (source, source_key, size, order)."""
    targets = source_targets(rows)
    counts = rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n"))
    fitted = stored(
        counts.join(targets, "source_key").where("size > 0").groupBy("source_key").applyInPandas(
            _fit, "source_key string, size long, source_size long, target double, passes long, extra long, parts long"),
        "fit")
    placed = rows.where("size > 0").join(fitted, ["source_key", "size"]).withColumn(
        "part", F.pmod(F.col("order"), F.col("parts")))
    in_part = ["source_key", "size", "part"]
    before = Window.partitionBy("source_key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*in_part).agg(F.count(F.lit(1)).alias("n"))
        .select(*in_part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy(*in_part).orderBy("order", "doc_id", "text_hash")
    ranked = placed.join(offsets, in_part).withColumn("rank", F.row_number().over(within) + F.col("offset"))
    taken = ranked.withColumn("copies", F.col("passes") + (F.col("rank") <= F.col("extra")).cast("long"))
    nothing = rows.where("size = 0").join(targets, "source_key").withColumn("copies", F.lit(0).cast("long"))
    columns = ["doc_id", "source", "text_hash", "size", "source_size", "target", "copies"]
    return taken.select(*columns).unionByName(nothing.select(*columns))


def _rows(docs: DataFrame) -> DataFrame:
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"), _key(source).alias("source_key"),
        n_words_of(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"),
        F.xxhash64("doc_id", F.lit(SEED)).alias("order"))


def _key(source: Column) -> Column:
    """A name that null has too and that no other source has."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def mixture(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target (of its source), taken (its words in the mix, repeats counted)."""
    planned = _plan(stored(_rows(docs), "sizes"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    rows = stored(_rows(docs).distinct(), "sizes")
    keys = ["__id", "__source", "__hash"]
    copies = _plan(rows).where("copies > 0").select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), _key(F.col("source")).alias("__source"),
        F.col("text_hash").alias("__hash"), F.col("doc_id").isNull().alias("__none"), F.col("copies").alias("__copies"))
    keyed = docs.select(
        "*", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("__id"),
        _key(F.col("source").cast("string")).alias("__source"), F.xxhash64("text").alias("__hash"),
        F.col("doc_id").isNull().alias("__none"))
    one = keyed.dropDuplicates([*keys, "__none"]).join(copies, [*keys, "__none"])
    return one.select(*[one[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), "__copies")).alias("__copy")).drop("__copy")
