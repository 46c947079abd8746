"""Incremental jobs: each run takes what has landed since the last one, and stops.

Every job works in micro-batches under a checkpoint, and a batch that is
repeated after a failure leaves the same table. The event log takes batch N as
the folder ``batch_id=N``, replacing it on a retry. What spans batches is
settled when a batch is written, so reading costs the live rows and not the
history: which delivery of an event was first, by an index of ids
(``streaming/unique.py``), which write of a record is last, by merging the
buckets of its keys (``plans/ingestion.py``). A new checkpoint over a table that
is there is refused, as its batches would not be those that the table knows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.plans.ingestion import upsert
from growthlake.sources import committed
from growthlake.sources.schemas import PRODUCT_EVENTS
from growthlake.streaming.unique import UniqueEvents, count_changes, read_activity, read_unique


def read_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    """A stream of the Parquet files at the path; ``max_files`` bounds a micro-batch, so a backlog is many of them."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def run_available(stream: DataFrame, table: str, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    spark = stream.sparkSession
    if _exists(spark, table) and not _exists(spark, checkpoint):
        raise ValueError(f"{table} has batches of another checkpoint than {checkpoint}")
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _write_batch(df: DataFrame, path: str, batch_id: int, partition_by: str | None = None) -> None:
    # dealt out by the folders, so a batch writes a few files a day and not one per task and day
    writer = df.hint("rebalance", partition_by) if partition_by else df
    writer = writer.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def append_events(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Bronze: every delivery, exactly once, in folders by day of the event."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch.withColumn("event_date", F.to_date("event_at")), path, batch_id, "event_date")

    run_available(stream, path, checkpoint, handle)


def dedup_events(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps the first delivery of each event; ``resolved_events`` reads them.

    It makes no difference when and in which order deliveries land, how far
    apart, nor on which day an event says it happened.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        UniqueEvents(batch.sparkSession, path, PRODUCT_EVENTS).add(batch, batch_id)

    run_available(stream, path, checkpoint, handle)


def resolved_events(spark: SparkSession, path: str) -> DataFrame:
    """The first delivery of each event over all batches."""
    return read_unique(spark, path, PRODUCT_EVENTS)


def daily_activity(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps first deliveries and, beside them, what they count per user and day; ``current_activity`` reads that."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        events = UniqueEvents(batch.sparkSession, path, PRODUCT_EVENTS)
        events.add(batch, batch_id)
        count_changes(events, f"{path}/daily")

    run_available(stream, path, checkpoint, handle)


def current_activity(spark: SparkSession, path: str) -> DataFrame:
    """User x account x day: late and repeated events count once, on their own day."""
    return read_activity(spark, f"{path}/daily")


def upsert_entities(stream: DataFrame, key: str, path: str, checkpoint: str) -> None:
    """Keeps the newest row per key, of the later batch on a tie.

    A path ``<root>/bronze/<name>`` makes it a bronze table as any load does.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, path, key, batch)

    run_available(stream, path, checkpoint, handle)


def current_entities(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per key over all batches."""
    commit = committed.latest(spark, path)
    return committed.read_folders(spark, path, commit.all_folders())
