"""The first delivery of each event over an unbounded stream, and what is counted from it.

A table is a set of runs, named by commits (``sources/committed.py``). A run has
the events that a batch added, an index of their ids in hash buckets, and a
Bloom filter per bucket. A batch is tested against the filters, bucket by
bucket, and then meets only those index files that may know one of its ids:
one small join, however old the other delivery is. A delivery that comes before
the one known so far replaces it: the old row is listed as removed. So reading
is the runs without the removed rows, and ranks nothing. Runs of about one size
are merged when there are ``FANOUT`` of them, so there are few.

What a batch added and removed stays beside it. Daily activity is counts per
user, account, day and event name, to which those changes are added and from
which they are taken away, by day. Both tables know the last batch they hold: a
batch that is repeated after a failure is taken up where it was left.
"""

from __future__ import annotations

import json
import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.functions.vocabulary import ACTIVITY_EVENTS
from growthlake.operators.ingest import CURSOR, delivery_content, delivery_order, first_per_key
from growthlake.sources import committed
from growthlake.sources.committed import Commit

BUCKETS = 16
FANOUT = 8
BITS_PER_ID, PROBES = 10, 7
PARTS = ("events", "ids", "filters")  # folders of a run
INDEX = f"event_id string, {CURSOR} timestamp_ntz, load_id string, content long, event_date date, run string"
COUNTS = "user_id string, account_id string, activity_date date, event_name string, n long"
NO_DAY = "none"


def _places(one: np.ndarray, two: np.ndarray, size: int) -> np.ndarray:
    """Bits of the keys in a filter, one row per probe."""
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (one.view(np.uint64) + steps * (two.view(np.uint64) | np.uint64(1))) % np.uint64(size)


def bloom_bits(one: np.ndarray, two: np.ndarray) -> bytes:
    size = max(64, BITS_PER_ID * len(one) // 8 * 8)
    bits = np.zeros(size, bool)
    bits[_places(one, two, size).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(filter_bits: bytes, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(filter_bits, np.uint8)).astype(bool)
    return bits[_places(one, two, len(bits))].all(axis=0)


def _with_hashes(ids: DataFrame, buckets: int) -> DataFrame:
    return ids.withColumns({
        "one": F.xxhash64("event_id"), "two": F.xxhash64(F.lit("two"), "event_id"),
        "bucket": F.pmod(F.xxhash64(F.lit("bucket"), "event_id"), F.lit(buckets)).cast("int")})


def _filters(ids: DataFrame, run: str, buckets: int) -> DataFrame:
    def build(rows: pa.Table) -> pa.Table:
        bits = bloom_bits(rows.column("one").to_numpy(), rows.column("two").to_numpy())
        return pa.table({"run": [run], "bucket": pa.array([rows.column("bucket")[0].as_py()], pa.int32()), "bits": [bits]})

    hashed = _with_hashes(ids, buckets).select("bucket", "one", "two")
    return hashed.groupBy("bucket").applyInArrow(build, "run string, bucket int, bits binary")


def _candidates(ids: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """(run, bucket) of the index files that may know one of the ids."""
    def probe(batch: pa.Table, known: pa.Table) -> pa.Table:
        one, two = batch.column("one").to_numpy(), batch.column("two").to_numpy()
        hit = [len(one) > 0 and bool(may_hold(bits.as_py(), one, two).any()) for bits in known.column("bits")]
        return known.select(["run", "bucket"]).filter(pa.array(hit, pa.bool_()))

    hashed = _with_hashes(ids, buckets).select("bucket", "one", "two")
    return hashed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, "run string, bucket int")


class UniqueEvents:
    """The table at ``path``; ``schema`` is that of the stream."""

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path
        self.schema = f"{schema}, event_date date, run string"
        self.commit = committed.latest(spark, path) or Commit(buckets=buckets)
        state = json.loads(self.commit.cursor) if self.commit.cursor else {"batch": -1, "rows": {}, "removed": [], "changes": None}
        self.batch: int = state["batch"]
        self.rows: dict[str, int] = state["rows"]
        self.removed: list[str] = state["removed"]
        self.last_changes: str | None = state["changes"]

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        return committed.read_folders(self.spark, self.path, folders, schema)

    @property
    def runs(self) -> list[str]:
        return [f.split("/")[1] for f in self.commit.folders.get("events", [])]

    def _run_folders(self, part: str, runs: list[str] | None = None) -> list[str]:
        return [f"data/{r}/{part}" for r in (self.runs if runs is None else runs)]

    def _live(self, rows: DataFrame) -> DataFrame:
        if not self.removed:
            return rows
        gone = self._read(self.removed, self.schema).select("event_id", "run")
        same = rows["event_id"].eqNullSafe(gone["event_id"]) & (rows["run"] == gone["run"])
        return rows.join(gone, same, "left_anti")

    def read(self) -> DataFrame:
        return self._live(self._read(self._run_folders("events"), self.schema)).drop("event_date", "run")

    def _publish(self, runs: list[str]) -> None:
        state = {"batch": self.batch, "rows": self.rows, "removed": self.removed, "changes": self.last_changes}
        folders = {part: self._run_folders(part, runs) for part in PARTS} | {"removed": self.removed}
        self.commit = Commit(self.commit.version + 1, folders, json.dumps(state), self.commit.buckets)
        committed.publish(self.spark, self.path, self.commit)

    def _write_run(self, run: str, events: DataFrame) -> int:
        """Events, index and filters of a run; its number of rows."""
        at = f"{self.path}/data/{run}"
        events.hint("rebalance", "event_date").write.parquet(f"{at}/events")
        events = self._read([f"data/{run}/events"], self.schema)
        ids = events.withColumn("content", delivery_content()).select("event_id", CURSOR, "load_id", "content", "event_date", "run")
        ids = _with_hashes(ids, self.commit.buckets).drop("one", "two")
        ids.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{at}/ids")
        _filters(events, run, self.commit.buckets).write.parquet(f"{at}/filters")
        return events.count()

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Takes up a batch, once: one that is in the table already changes nothing."""
        if batch_id <= self.batch:
            return
        run = uuid.uuid4().hex
        runs, work = self.runs, f"data/{run}"
        first = first_per_key(batch, ["event_id"], delivery_order())
        first = first.withColumns({"event_date": F.to_date("event_at"), "run": F.lit(run)})
        first.write.parquet(f"{self.path}/{work}/batch")
        first = self._read([f"{work}/batch"], self.schema)
        removed = None
        if runs:
            filters = self._read(self._run_folders("filters"), "run string, bucket int, bits binary")
            # at most one row per run and bucket, and runs are few
            files = [f"data/{r.run}/ids/bucket={r.bucket}"
                     for r in _candidates(first, filters, self.commit.buckets).distinct().collect()]
            if files:
                known = self._live(self._read(files, INDEX))
                known = known.select(F.col("event_id").alias("known_id"), F.struct(CURSOR, "load_id", "content").alias("known_as"),
                                     F.col("run").alias("known_run"))
                met = first.withColumn("comes_as", F.struct(
                    CURSOR, "load_id", delivery_content().alias("content"))).join(
                        known, F.col("event_id").eqNullSafe(F.col("known_id")), "left")
                met.where(F.col("known_run").isNull() | (F.col("comes_as") < F.col("known_as"))).select(
                    *first.columns, "known_run").write.parquet(f"{self.path}/{work}/new")
                news = self._read([f"{work}/new"], f"{self.schema}, known_run string")
                first = news.drop("known_run")
                removed = news.where("known_run IS NOT NULL").select(F.col("event_id").alias("old_id"), "known_run")
        n = self._write_run(run, first)
        self.rows = self.rows | {run: n}
        if removed is not None and removed.limit(1).count():
            replaced = sorted(r[0] for r in removed.select("known_run").distinct().collect())
            old = self._read(self._run_folders("events", replaced), self.schema)
            same = old["event_id"].eqNullSafe(removed["old_id"]) & (old["run"] == removed["known_run"])
            old.join(removed, same, "left_semi").write.parquet(f"{self.path}/{work}/removed")
            self.removed = [*self.removed, f"{work}/removed"]
        self.batch, self.last_changes = batch_id, run
        self._publish([*runs, run])
        self.merge_runs()

    def changes(self) -> tuple[DataFrame, DataFrame]:
        """The events that the last batch added and those it removed."""
        work = f"data/{self.last_changes}"
        removed = [f for f in self.removed if f == f"{work}/removed"]
        return self._read([f"{work}/events"], self.schema), self._read(removed, self.schema)

    def merge_runs(self) -> None:
        """Makes one run of those of a size class that is full; the last batch's stays as it is."""
        runs = self.runs
        classes: dict[int, list[str]] = {}
        for r in runs:
            if r != self.last_changes:
                classes.setdefault(int(math.log(self.rows[r] + 1, FANOUT)), []).append(r)
        for full in classes.values():
            if len(full) >= FANOUT:
                run = uuid.uuid4().hex
                events = self._live(self._read(self._run_folders("events", full), self.schema))
                n = self._write_run(run, events.withColumn("run", F.lit(run)))
                self.rows = {r: k for r, k in self.rows.items() if r not in full} | {run: n}
                self._forget_removed(full)
                self._publish([run, *(r for r in runs if r not in full)])
                return

    def _forget_removed(self, merged: list[str]) -> None:
        """Removed rows of merged runs are gone for good; only those of other runs must still be left out."""
        latest = f"data/{self.last_changes}/removed"
        others = [f for f in self.removed if f != latest]
        if others:
            left = self._read(others, self.schema).where(~F.col("run").isin(merged))
            folder = f"data/{uuid.uuid4().hex}/removed"
            left.write.parquet(f"{self.path}/{folder}")
            self.removed = [folder, *(f for f in self.removed if f == latest)]


def read_unique(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The first delivery of each event."""
    return UniqueEvents(spark, path, schema).read()


def _counts(events: DataFrame, sign: int) -> DataFrame:
    return (
        events.where(F.col("event_name").isin(ACTIVITY_EVENTS))
        .groupBy(F.col("distinct_id").alias("user_id"), "account_id", F.to_date("event_at").alias("activity_date"), "event_name")
        .agg((F.count(F.lit(1)) * sign).alias("n")))


def count_changes(events: UniqueEvents, path: str) -> None:
    """Brings the counts at ``path`` to the last batch of ``events``; days that it does not change stay as they are."""
    spark = events.spark
    before = committed.latest(spark, path) or Commit()
    last = -1 if before.cursor is None else int(before.cursor)
    if last >= events.batch:
        return
    if last == events.batch - 1:
        added, removed = events.changes()
        change = _counts(added, 1).unionByName(_counts(removed, -1))
    else:
        # batches were added without being counted: counted anew, once
        before = Commit(before.version)
        change = _counts(events.read(), 1)
    day = F.coalesce(F.col("activity_date").cast("string"), F.lit(NO_DAY))
    folder = committed.new_data_folder()
    change.write.parquet(f"{path}/{folder}/change")
    change = committed.read_folders(spark, path, [f"{folder}/change"], COUNTS)
    days = sorted(r[0] for r in change.select(day.alias("day")).distinct().collect())
    had = committed.read_folders(spark, path, [f for d in days for f in before.folders.get(d, [])], COUNTS)
    keys = ["user_id", "account_id", "activity_date", "event_name"]
    summed = had.unionByName(change).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")
    summed.withColumn("day", day).hint("rebalance", "day").write.partitionBy("day").parquet(f"{path}/{folder}/counts")
    there = set(committed.names_in(spark, f"{path}/{folder}/counts"))
    folders = {d: f for d, f in before.folders.items() if d not in days}
    folders |= {d: [f"{folder}/counts/day={d}"] for d in days if f"day={d}" in there}
    committed.publish(spark, path, Commit(before.version + 1, folders, str(events.batch)))


def read_activity(spark: SparkSession, path: str) -> DataFrame:
    """User x account x day, from the counts."""
    commit = committed.latest(spark, path) or Commit()
    counts = committed.read_folders(spark, path, commit.all_folders(), COUNTS)
    return counts.groupBy("user_id", "account_id", "activity_date").agg(
        F.sum("n").alias("event_count"), F.count(F.lit(1)).alias("distinct_features"))
