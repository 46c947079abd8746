"""What the text operators share: reading, shared intermediate tables, word splitting, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.session import new_folder, tune

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the folder all executors share: lineage ends there, a lost executor costs no rerun."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Removes stored tables that nothing will read again: all that came from them is stored itself."""
    for df in tables:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """Array of words; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text at most, one row at least."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())])
        start = 0
        while start < batch.num_rows:
            stop = start + 1
            while stop < batch.num_rows and ends[stop + 1] - ends[start] <= limit:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut so that none ends within a group; groups must be of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        edge = batch.num_rows - 1
        last = [batch.column(k)[edge].as_py() for k in keys]
        starts = np.flatnonzero(changes(batch, keys))
        # the rows before the last group are whole, if a group starts in this batch at all
        cut = int(starts[-1]) if len(starts) else 0
        if held and (cut or [held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in keys] != last):
            done = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        else:
            done = pa.Table.from_batches([batch.slice(0, cut)]) if cut else None
        if done is not None and done.num_rows:
            yield done.combine_chunks().to_batches()[0]
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Per row, except the first, whether a key differs from the row before; null equals null."""
    out = np.zeros(batch.num_rows, bool)
    for key in keys:
        column = batch.column(key)
        now, before = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(now, before), False).to_numpy(zero_copy_only=False)
        nulls = pc.is_null(now).to_numpy(zero_copy_only=False) != pc.is_null(before).to_numpy(zero_copy_only=False)
        out[1:] |= differ | nulls
    return out


def ranked(
    df: DataFrame, group: list[str], order: list[str], place: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """The rows, stored, with their place (from 0) among those of their group; nulls come first.

    Columns in ``drop`` serve the order only.

    Ranges of (group, order) are sorted in tasks, so a group may be of any size.
    A row's place in its range is counted on the way; only a range's first group
    can have begun earlier, so one offset per range completes it. Rows alike in
    all those columns are dealt by a number of their own.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    in_ranges = numbered.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie", *drop)
    in_ranges = in_ranges.withColumn("_range", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, runs, length = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            new = changes(batch, group)
            first = [batch.column(k)[0].as_py() for k in group]
            if last is not None and first != last:
                runs, length = runs + 1, 0
            last = [batch.column(k)[n - 1].as_py() for k in group]
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, 0))
            number = np.cumsum(new)
            within = at - start + np.where(number == 0, length, 0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(within, pa.int64()), pa.array(number + runs, pa.int64())],
                names=[*batch.schema.names, "_within", "_run"])
            runs, length = runs + int(number[-1]), int(within[-1]) + 1

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in in_ranges.schema)
    counted = stored(in_ranges.mapInArrow(run, f"{schema}, _within long, _run long"), "ranges")
    ends = counted.groupBy("_range").agg(
        F.min(F.struct("_run", *group)).alias("first"), F.max(F.struct("_run", "_within", *group)).alias("last"))
    # a row per range, which is a task of the sort: bounded by the number of shuffle partitions
    offsets, begun, so_far = [], None, 0
    for r in sorted(ends.collect()):
        first, final = [r["first"][g] for g in group], [r["last"][g] for g in group]
        offset = so_far if first == begun else 0
        offsets.append((r["_range"], offset))
        begun, so_far = final, r["last"]["_within"] + 1 + (offset if r["last"]["_run"] == 0 else 0)
    shifts = df.sparkSession.createDataFrame(offsets, "_range int, _offset long")
    shift = F.when(F.col("_run") == 0, F.col("_offset")).otherwise(F.lit(0))
    return counted.join(F.broadcast(shifts), "_range").withColumn(place, F.col("_within") + shift).drop(
        "_range", "_within", "_run", "_offset")


def components(links: DataFrame, a: str = "a", b: str = "b", tasks: int | None = None) -> DataFrame:
    """(node, component) for every node that a link names; the component is its smallest node.

    Each round gives a node the least label among its own, its neighbours' and
    the label of that label, so paths halve. Minima combine before the shuffle
    and a hub's links are the split side of the join. Rounds are written to the
    shared folder and end when no label moves. A round over few links may do
    with so many ``tasks``.
    """
    def within(df: DataFrame) -> DataFrame:
        return df if tasks is None else df.coalesce(tasks)

    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = stored(within(both.union(both.select("y", "x")).distinct()), "links")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least"))
    labels = stored(within(labels.select("node", F.least("node", "least").alias("component"))), "labels")
    while True:
        near = within(
            within(both.join(labels.select(F.col("node").alias("y"), F.col("component").alias("c")), "y"))
            .groupBy(F.col("x").alias("node")).agg(F.min("c").alias("c"))
        )
        step = within(labels.join(near, "node")).select(
            "node", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        up = step.select(F.col("node").alias("component"), F.col("component").alias("up"))
        step = stored(
            within(step.join(up, "component"))
            .select("node", "old", F.least("component", "up").alias("component")), "labels")
        moved = step.where("component <> old").limit(1).count()
        forget(labels)
        labels = step
        if not moved:
            forget(both)
            return labels.select("node", "component")
