"""Brings a stored warehouse up to date by rewriting what changed input can reach.

Tables over events lie in month folders. A refresh looks at the bronze folders
that no earlier one has seen, finds the months that their events (or other
deliveries of them) lie in, and rewrites those months of the event models; the
week models also the month before, where a week begins. Models that look at an
account's whole life read compact tables kept per month beside the models:
spans of event times, times of activation signals, weeks with activity. Other
models are rewritten when an input changed, and count as changed only if their
rows do. All of it is named in one commit (``sources/committed.py``): a refresh
that dies leaves the last state, and one without new input writes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from growthlake.functions.vocabulary import ACTIVATION_SIGNALS, SIGNUP_EVENT
from growthlake.operators import core, facts, staging
from growthlake.operators.ingest import CURSOR, delivery_content, first_per_key
from growthlake.plans.warehouse import MODELS, STAGING, Warehouse
from growthlake.sources import committed
from growthlake.sources.committed import ALL, Commit
from growthlake.sources.schemas import BRONZE

MONTH = "in_month"
NO_MONTH = "none"

# beside the models: the months an event id was delivered for, ids of several months, and compact tables per month
IDS, STRAYS, SPANS, SIGNALS, WEEKS = "event_ids", "event_strays", "event_spans", "signal_times", "int_active_weeks"

EVENT_MONTHS = ["stg_product_events", SPANS, SIGNALS]
ACTIVITY_MONTHS = ["int_user_activity", "fct_user_daily_activity", "int_account_usage", WEEKS]
WEEK_MONTHS = ["int_feature_usage", "fct_feature_adoption"]
BY_MONTH = [*EVENT_MONTHS, *ACTIVITY_MONTHS, *WEEK_MONTHS, "fct_product_events", "fct_usage_expansion"]

# what the other models are computed from, in an order in which each comes after its inputs
INPUTS: dict[str, list[str]] = {
    **{name: [name.replace("stg_", "")] for name in STAGING if name != "stg_product_events"},
    "int_identity_mapping": [SPANS, "stg_crm_companies", "stg_billing_customers"],
    "int_user_activation": [SIGNALS],
    "int_subscription_history": ["stg_billing_subscriptions", "stg_billing_prices", "stg_billing_customers"],
    "dim_accounts": ["int_identity_mapping", "stg_crm_companies", "int_subscription_history"],
    "dim_dates": [SPANS],
    "dim_features": [],
    "dim_plans": ["stg_billing_prices"],
    "fct_user_activation": ["int_user_activation"],
    "fct_user_journey": [SPANS],
    "fct_subscription_history": ["int_subscription_history"],
    "fct_account_mrr": ["int_subscription_history", "as_of"],
    "fct_paid_conversion": ["int_identity_mapping", "int_subscription_history"],
    "fct_churn": ["int_subscription_history"],
    "fct_retention": ["fct_user_activation", WEEKS],
    "fct_paid_base_daily": ["fct_subscription_history"],
}
# a model over events gets these in their place: they hold what it looks at
STANDS_FOR_EVENTS = {
    "int_identity_mapping": SPANS, "dim_dates": SPANS, "fct_user_journey": SPANS, "int_user_activation": SIGNALS}


def month_of(at) -> Column:
    return F.coalesce(F.date_format(at, "yyyy-MM"), F.lit(NO_MONTH))


def _shifted(month: str, by: int) -> str:
    if month == NO_MONTH:
        return month
    number = int(month[:4]) * 12 + int(month[5:]) - 1 + by
    return f"{number // 12:04d}-{number % 12 + 1:02d}"


class Refresh:
    """One refresh: what was there, what it has written so far, and which tables and months changed."""

    def __init__(self, spark: SparkSession, lake: str, root: str, as_of: str):
        self.spark, self.lake, self.root, self.as_of = spark, lake, root, as_of
        self.before = committed.latest(spark, root)
        state = json.loads(self.before.cursor) if self.before else {"inputs": {}, "schemas": {}, "prints": {}, "as_of": None}
        self.seen: dict[str, list[str]] = state["inputs"]
        self.schemas: dict[str, str] = state["schemas"]
        self.prints: dict[str, str] = state["prints"]
        self.folders = dict(self.before.folders) if self.before else {}
        self.data = f"data/{uuid.uuid4().hex}"
        self.changed: set[str] = set() if state["as_of"] == as_of else {"as_of"}
        self.months: dict[str, set[str]] = {}
        self.inputs: dict[str, list[str]] = {}

    # tables

    def _key(self, name: str, part: str = ALL) -> str:
        return f"{name}/{part}"

    def stored_months(self, name: str) -> set[str]:
        return {k.partition("/")[2] for k in self.folders if k.startswith(f"{name}/")} - {ALL}

    def read(self, name: str, months: set[str] | None = None) -> DataFrame:
        """A table, or some of its months only; no other file is opened."""
        parts = [ALL] if name not in BY_MONTH else sorted(self.stored_months(name) if months is None else months)
        folders = [f for p in parts for f in self.folders.get(self._key(name, p), [])]
        return committed.read_folders(self.spark, self.root, folders, self.schemas[name])

    def _written(self, name: str, df: DataFrame, partition_by: str | None = None) -> str:
        folder = f"{self.data}/{name}"
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(f"{self.root}/{folder}")
        columns = [f for f in df.schema if f.name != partition_by]
        self.schemas[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        return folder

    def write_months(self, name: str, df: DataFrame, month: Column, months: set[str]) -> None:
        """Replaces these months of a table; the rows of ``df`` must lie in them."""
        folder = self._written(name, df.withColumn("_part", month), "_part")
        there = {n.partition("=")[2] for n in committed.names_in(self.spark, f"{self.root}/{folder}") if n.startswith("_part=")}
        for m in months:
            self.folders.pop(self._key(name, m), None)
            if m in there:
                self.folders[self._key(name, m)] = [f"{folder}/_part={m}"]
        self.months[name] = months
        self.changed.add(name)

    def write_whole(self, name: str, df: DataFrame) -> None:
        """Replaces a table; one with the same rows as before stays, and does not count as changed.

        What tells the rows is added up while they are written, by the tasks that write.
        """
        seen = Observation()
        content = F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
        folder = self._written(name, df.observe(
            seen, F.count(F.lit(1)).alias("rows"), F.sum(content.cast("decimal(38,0)")).alias("content")))
        mark = f"{seen.get['rows']}:{seen.get['content']}"
        if self.prints.get(name) != mark:
            self.prints[name] = mark
            self.folders[self._key(name)] = [folder]
            self.changed.add(name)

    # events

    def _deliveries(self, folders: list[str], months: set[str] | None = None) -> DataFrame:
        """Deliveries of these folders, or of those among them that are of these months."""
        named = f"{committed.EVENT_MONTH}="
        folders = [f for f in folders if months is None or f.rpartition(named)[2] in months]
        return committed.read_folders(self.spark, f"{self.lake}/bronze/product_events", folders, BRONZE["product_events"])

    def _event_months(self, everything: list[str], new: list[str]) -> set[str]:
        """The months that the new deliveries, and earlier ones of the same events, lie in."""
        order = F.struct(F.col(CURSOR).alias("at"), "load_id", "content")
        ids = self._deliveries(new).withColumn("content", delivery_content()).select(
            "event_id", month_of("event_at").alias("month"), CURSOR, "load_id", "content")
        ids = first_per_key(ids, ["event_id", "month"], [F.asc(CURSOR), F.asc("load_id"), F.asc("content")])
        folder = self._written(IDS, ids)
        earlier = self.folders.get(self._key(IDS), [])
        self.folders[self._key(IDS)] = [*earlier, folder]
        ids = committed.read_folders(self.spark, self.root, [folder], self.schemas[IDS])
        if not earlier:
            touched = ids
        else:
            known = committed.read_folders(self.spark, self.root, earlier, self.schemas[IDS])
            fresh = ids.select(F.col("event_id").alias("_id")).distinct()
            touched = known.join(fresh, F.col("event_id").eqNullSafe(F.col("_id")), "left_semi").unionByName(ids)
        strays = touched.groupBy("event_id").agg(
            F.count_distinct("month").alias("n"), F.min_by("month", order).alias("month")).where("n > 1").drop("n")
        if earlier:
            # ids whose deliveries lie in several months, and the month of the one that counts
            fresh = ids.select(F.col("event_id").alias("_id")).distinct()
            others = self.read(STRAYS).join(fresh, F.col("event_id").eqNullSafe(F.col("_id")), "left_anti")
            strays = others.unionByName(strays)
        self.folders[self._key(STRAYS)] = [self._written(STRAYS, strays)]
        return {r[0] for r in touched.select("month").distinct().collect()}

    def _stage_events(self, everything: list[str], months: set[str]) -> None:
        staged = staging.stg_product_events(self._deliveries(everything, months))
        elsewhere = self.read(STRAYS).select(F.col("event_id").alias("_id"), F.col("month").alias("_month"))
        beyond = F.col("event_id").eqNullSafe(F.col("_id")) & (month_of("event_at") != F.col("_month"))
        staged = staged.join(elsewhere, beyond, "left_anti")
        self.write_months("stg_product_events", staged, month_of("event_at"), months)
        events = self.read("stg_product_events", months)
        spans = events.groupBy("account_id", "event_name", month_of("event_at").alias(MONTH)).agg(
            F.min("event_at").alias("event_at"), F.max("event_at").alias("last_at"))
        self.write_months(SPANS, spans, F.col(MONTH), months)
        signals = events.where(F.col("event_name").isin([*ACTIVATION_SIGNALS.values(), SIGNUP_EVENT]))
        signals = signals.select("account_id", "event_name", "event_at").distinct()
        self.write_months(SIGNALS, signals, month_of("event_at"), months)

    def _use_events(self, months: set[str]) -> None:
        self.write_months("int_user_activity", core.int_user_activity(self.read("stg_product_events", months)),
                          month_of("activity_date"), months)
        activity = self.read("int_user_activity", months)
        self.write_months("fct_user_daily_activity", facts.fct_user_daily_activity(activity), month_of("activity_date"), months)
        self.write_months("int_account_usage", core.int_account_usage(activity), month_of("usage_month"), months)
        weeks = core.int_active_weeks(activity, month_of("activity_date").alias(MONTH))
        self.write_months(WEEKS, weeks, F.col(MONTH), months)

        begun = months | {_shifted(m, -1) for m in months}
        needed = begun | {_shifted(m, 1) for m in begun}
        usage = core.int_feature_usage(self.read("stg_product_events", needed)).where(month_of("usage_week").isin(sorted(begun)))
        self.write_months("int_feature_usage", usage, month_of("usage_week"), begun)
        adoption = facts.fct_feature_adoption(
            self.read("int_feature_usage", begun), self.read("int_user_activity", needed))
        self.write_months("fct_feature_adoption", adoption, month_of("week"), begun)

    # the other models

    def _model(self, name: str) -> DataFrame:
        def table(of: str) -> DataFrame:
            if of == "stg_product_events":
                of = STANDS_FOR_EVENTS[name]
            elif of == WEEKS:
                return self.active_weeks()
            elif of in BRONZE:
                return committed.read(self.spark, f"{self.lake}/bronze/{of}", BRONZE[of])
            rows = self.read(of)
            if name == "dim_dates":
                # its calendar runs from the first event to the last
                return rows.select("event_at").unionByName(rows.select(F.col("last_at").alias("event_at")))
            return rows

        return MODELS[name](_Tables(self.spark, self.as_of, table))

    def active_weeks(self) -> DataFrame:
        """The words of all months; a week at a month's end may be in two of them."""
        return self.read(WEEKS).groupBy("account_id", "era").agg(F.bit_or("weeks").alias("weeks"))

    def _accounts_changed(self, name: str, old: DataFrame) -> DataFrame:
        new = self.read(name)
        moved = new.exceptAll(old).unionByName(old.exceptAll(new))
        return moved.select("account_id").distinct()

    def _months_with(self, accounts: DataFrame) -> set[str]:
        named = accounts.select(F.col("account_id").alias("_id"))
        found = self.read(SPANS).join(named, F.col("account_id").eqNullSafe(F.col("_id")), "left_semi")
        return {r[0] for r in found.select(MONTH).distinct().collect()}

    def _update_models(self, threads: int = 4) -> None:
        """The models over whole tables whose inputs have changed, a few at a time, each after its inputs."""
        def update(name: str) -> None:
            if self.before is None or self.changed & set(INPUTS[name]):
                self.write_whole(name, self._model(name))

        pending = dict(INPUTS)
        with ThreadPoolExecutor(threads) as pool:
            while pending:
                ready = [name for name, needs in pending.items() if not pending.keys() & set(needs)]
                list(pool.map(update, ready))
                for name in ready:
                    del pending[name]

    def run(self) -> Commit | None:
        for name in BRONZE:
            commit = committed.latest(self.spark, f"{self.lake}/bronze/{name}")
            self.inputs[name] = commit.all_folders() if commit else []
            if self.before is None or self.inputs[name] != self.seen[name]:
                self.changed.add(name)
        if self.before is not None and not self.changed:
            return None
        events = self.inputs["product_events"]
        new = sorted(set(events) - set(self.seen.get("product_events", [])))
        if new or self.before is None:
            months = self._event_months(events, new)
            self._stage_events(events, months)
            self._use_events(months)
        identity_before = self.read("int_identity_mapping") if self.before is not None else None
        self._update_models()
        months = self.months.get("stg_product_events", set())
        if "int_identity_mapping" in self.changed:
            months = months | (
                self.stored_months("stg_product_events") if identity_before is None
                else self._months_with(self._accounts_changed("int_identity_mapping", identity_before)))
        if months or self.before is None:
            joined = facts.fct_product_events(self.read("stg_product_events", months), self.read("int_identity_mapping"))
            self.write_months("fct_product_events", joined, month_of("event_at"), months)
        self._expand_usage()
        state = {"inputs": self.inputs, "schemas": self.schemas, "prints": self.prints, "as_of": self.as_of}
        after = Commit((self.before.version if self.before else 0) + 1, self.folders, json.dumps(state))
        committed.publish(self.spark, self.root, after)
        return after

    def _expand_usage(self) -> None:
        """Account x month: the months of changed usage, or all where MRR changed."""
        if not self.changed & {"int_account_usage", "fct_account_mrr"}:
            return
        mrr = self.read("fct_account_mrr")
        if "fct_account_mrr" in self.changed:
            with_mrr = {r[0] for r in mrr.select(month_of("mrr_month")).distinct().collect()}
            months = with_mrr | self.stored_months("int_account_usage") | self.stored_months("fct_usage_expansion")
        else:
            months = self.months["int_account_usage"]
        mrr = mrr.where(month_of("mrr_month").isin(sorted(months)))
        both = facts.fct_usage_expansion(self.read("int_account_usage", months), mrr)
        self.write_months("fct_usage_expansion", both, month_of("month"), months)


class _Tables:
    """What a model's formula needs of a warehouse."""

    def __init__(self, spark: SparkSession, as_of: str, table: Callable[[str], DataFrame]):
        self.spark, self.as_of, self._table = spark, as_of, table

    def __getitem__(self, name: str) -> DataFrame:
        return self._table(name)


def refresh(spark: SparkSession, lake: str, root: str, as_of: str | date) -> Commit | None:
    """Writes what the bronze tables under ``lake`` have changed since the last refresh of ``root``; none if nothing."""
    return Refresh(spark, lake, root, str(as_of)).run()


def opened(spark: SparkSession, root: str) -> Warehouse:
    """The warehouse as of the last refresh, for reports and checks."""
    state = committed.latest(spark, root)
    if state is None:
        raise FileNotFoundError(f"no refresh under {root}")
    as_of = json.loads(state.cursor)["as_of"]
    last = Refresh(spark, "", root, as_of)

    def missing(name: str) -> DataFrame:
        raise KeyError(f"{name} is no table of the warehouse")

    tables = {name: last.read(name) for name in MODELS} | {WEEKS: last.active_weeks()}
    return Warehouse.over(spark, tables, missing, as_of)


def row_counts(warehouse: Warehouse) -> DataFrame:
    """Rows per model."""
    counts = [
        warehouse[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in MODELS
    ]
    return reduce(DataFrame.unionByName, counts)
