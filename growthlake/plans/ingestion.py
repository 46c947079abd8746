"""From landed loads to the bronze tables under ``<root>/bronze``, over and over again.

Events are appended from the stored cursor on. The other collections are merged
by key, the newest write winning: their tables lie in hash buckets of the key,
and a load reads and rewrites only the buckets it has keys of. Every load ends
with a commit (``sources/committed.py``), so one that dies at any step can be
run again, and one that comes again, whole or in part, changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.operators.ingest import CURSOR, append_incremental, merge_latest, updated_since
from growthlake.sources import committed
from growthlake.sources.committed import EVENT_MONTH, Commit
from growthlake.sources.schemas import BRONZE, MERGE_KEYS

BUCKETS = 16
BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def load(
    spark: SparkSession, name: str, incoming: DataFrame, root: str, since: str | None = None, buckets: int = BUCKETS
) -> Commit:
    """One load of one collection; ``since`` leaves out rows written before it.

    ``buckets`` counts when the table is made; a bucket should hold what a task
    can sort, as a merge handles each on its own.
    """
    path = f"{root}/bronze/{name}"
    if since is not None:
        incoming = updated_since(incoming, since)
    if name in MERGE_KEYS:
        return upsert(spark, path, MERGE_KEYS[name], incoming, buckets)
    before = committed.latest(spark, path)
    return _committed(spark, path, before, _append(spark, path, name, incoming, before or Commit()))


def upsert(spark: SparkSession, path: str, key: str, incoming: DataFrame, buckets: int = BUCKETS) -> Commit:
    """Merges rows into the table at ``path``: per key the newest write stays, the later load's on a tie."""
    before = committed.latest(spark, path)
    return _committed(spark, path, before, _merge(spark, path, key, incoming, before or Commit(buckets=buckets)))


def _committed(spark: SparkSession, path: str, before: Commit | None, after: Commit | None) -> Commit:
    """A load that changes nothing needs no commit, unless it makes the table."""
    if after is None and before is not None:
        return before
    after = after or Commit(1)
    committed.publish(spark, path, after)
    return after


def _append(spark: SparkSession, path: str, name: str, incoming: DataFrame, before: Commit) -> Commit | None:
    """Writes what is new beside the table, in folders by month of the event; none where nothing is.

    The source is scanned with a bound on its cursor column. The new cursor is
    that of the rows written, so it never lies beyond what the commit names.
    """
    if before.folders:
        existing = committed.read_folders(spark, path, before.all_folders(), BRONZE[name])
        incoming = append_incremental(existing, incoming, before.cursor)
    folder = committed.new_data_folder()
    by_month = incoming.withColumn(EVENT_MONTH, F.coalesce(F.date_format("event_at", "yyyy-MM"), F.lit("none")))
    by_month.hint("rebalance", EVENT_MONTH).write.partitionBy(EVENT_MONTH).parquet(f"{path}/{folder}")
    months = [n for n in committed.names_in(spark, f"{path}/{folder}") if n.startswith(f"{EVENT_MONTH}=")]
    if not months:
        return None
    new = [f"{folder}/{m}" for m in months]
    newest = committed.read_folders(spark, path, new, BRONZE[name]).agg(F.max(CURSOR).cast("string")).first()[0]
    # cursors are text of one form, but fractions of a second may be missing: compared as times
    cursor = max((c for c in (before.cursor, newest) if c is not None), key=_seconds, default=None)
    folders = dict(before.folders)
    for month, added in zip(months, new):
        month = month.partition("=")[2]
        folders[month] = [*folders.get(month, []), added]
    return Commit(before.version + 1, folders, cursor)


def _seconds(cursor: str) -> tuple[str, str]:
    whole, _, fraction = cursor.partition(".")
    return whole, fraction.ljust(6, "0")


def _content(df: DataFrame, columns: list[str]) -> Column:
    return F.xxhash64(F.to_json(F.struct(*(F.col(c) for c in columns if c in df.columns))))


def _buckets_changed(existing: DataFrame | None, newest: DataFrame, key: str) -> list[int]:
    """The buckets with a key that is new, or newer than in the table; at most one row each comes to the driver."""
    if existing is not None:
        columns = sorted({*newest.columns, *existing.columns})
        here = existing.select(
            F.col(key).alias("_key"), F.col(CURSOR).alias("_at"), _content(existing, columns).alias("_had"), F.lit(True).alias("_there"))
        newest = newest.withColumn("_has", _content(newest, columns)).join(here, F.col(key).eqNullSafe(F.col("_key")), "left")
        newer = F.coalesce(F.col(CURSOR) > F.col("_at"), F.col(CURSOR).isNotNull() & F.col("_at").isNull())
        tie = F.col(CURSOR).eqNullSafe(F.col("_at")) & (F.col("_has") != F.col("_had"))
        newest = newest.where(F.col("_there").isNull() | newer | tie)
    return sorted(r[0] for r in newest.select(BUCKET).distinct().collect())


def _merge(spark: SparkSession, path: str, key: str, incoming: DataFrame, before: Commit) -> Commit | None:
    """Rewrites the buckets that the load changes; the files of all others stay, unread if it has no key of theirs.

    The load is computed once: the first one goes straight to the table, later
    ones are held on the executors' disks while they are compared and merged.
    """
    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(key, before.buckets))

    def existing(buckets: list[int]) -> DataFrame | None:
        folders = sorted(f for b in buckets for f in before.folders.get(str(b), []))
        return bucketed(committed.read_folders(spark, path, folders)) if folders else None

    def written(merged: DataFrame) -> dict[str, list[str]]:
        folder = committed.new_data_folder()
        merged.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        named = [n for n in committed.names_in(spark, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")]
        return {n.partition("=")[2]: [f"{folder}/{n}"] for n in named}

    newest = merge_latest([bucketed(incoming)], key)
    if not before.folders:
        folders = written(newest)
        if not folders and before.version:
            return None
        return Commit(before.version + 1, folders, None, before.buckets)
    newest = newest.persist(StorageLevel.DISK_ONLY)
    try:
        met = sorted(r[0] for r in newest.select(BUCKET).distinct().collect())
        changed = _buckets_changed(existing(met), newest, key)
        if not changed:
            return None
        old = existing(changed)
        loads = [newest.where(F.col(BUCKET).isin(changed))]
        new = written(merge_latest(loads if old is None else [old, *loads], key))
    finally:
        newest.unpersist()
    return Commit(before.version + 1, {**before.folders, **new}, None, before.buckets)


def run(spark: SparkSession, landed: Mapping[str, DataFrame], root: str, since: str | None = None, threads: int = 4) -> None:
    """A load of every collection that has landed, a few at a time."""
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(lambda name: load(spark, name, landed[name], root, since), landed))
