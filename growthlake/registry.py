"""All queries by name, over the driver tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.functions import semantics, standardise
from growthlake.operators import history, ingest, quality, staging
from growthlake.plans import audience, ingestion, refresh
from growthlake.plans.metrics import METRICS
from growthlake.plans.reports import REPORTS
from growthlake.plans.warehouse import CORE, MARTS, MODELS, STAGING, Warehouse
from growthlake.session import new_folder, tune
from growthlake.sources import committed, driver_tables, landing, schemas
from growthlake.sources.driver_tables import AS_OF
from growthlake.sources.layers import read_bronze
from growthlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]


# tables with one use in most reports, of which that needs a few columns only
COMPOSED = [name for name in STAGING if name != "stg_product_events"] + ["int_subscription_history"]


def _sized(spark: SparkSession, sf_dir: str) -> SparkSession:
    return tune(spark, driver_tables.input_bytes(spark, sf_dir))


def _over_driver_tables(spark: SparkSession, sf_dir: str, root: str | None = None) -> Warehouse:
    return Warehouse(_sized(spark, sf_dir), lambda name: driver_tables.BRONZE[name](spark, sf_dir), AS_OF, root, COMPOSED)


@lru_cache(maxsize=4)
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Models composed over the driver tables; plans only, nothing is stored."""
    return _over_driver_tables(spark, sf_dir)


@lru_cache(maxsize=4)
def stored_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Models as tables in the shared folder, each written once per session when a report first needs it.

    Those in ``COMPOSED`` stay plans until a query over many models keeps them.
    """
    return _over_driver_tables(spark, sf_dir, new_folder(spark, "warehouse"))


# ingestion

def ingest_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "pages")
    landing.write_pages(driver_tables.product_events(spark, sf_dir), path)
    return landing.read_pages(spark, path, schemas.PRODUCT_EVENTS)


def ingest_updated_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.updated_since(driver_tables.product_events(spark, sf_dir), "2023-12-01 00:00:00")


def ingest_event_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.event_range(
        driver_tables.product_events(spark, sf_dir), "2023-10-01 00:00:00", "2023-11-01 00:00:00")


def ingest_keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API page of the largest size the contract allows."""
    keys = ["source_updated_at", "event_id", "load_id"]
    return ingest.keyset_page(
        driver_tables.product_events(spark, sf_dir), keys, ("2023-11-01 00:00:00", "", ""), 1000)


def ingest_append_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a first load to December and one of everything, from the stored cursor on."""
    root, source = new_folder(spark, "bronze"), driver_tables.product_events(spark, sf_dir)
    ingestion.load(spark, "product_events", source.where(F.col("source_updated_at") <= F.lit("2023-12-01").cast("timestamp_ntz")), root)
    ingestion.load(spark, "product_events", source, root)
    return committed.read(spark, f"{root}/bronze/product_events", schemas.PRODUCT_EVENTS)


def ingest_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads merged, then the first one again: merging is idempotent."""
    first, second = driver_tables.company_batches(spark, sf_dir)
    return ingest.merge_latest([first, second, first], "company_id")


def ingest_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.union_evolved(driver_tables.price_shapes(spark, sf_dir))


def ingest_flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.flatten_properties(driver_tables.product_events(spark, sf_dir))


@lru_cache(maxsize=4)
def backfilled_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All models after a first refresh that misses late November's events, and one with all that landed since."""
    lake, root = new_folder(spark, "lake"), new_folder(spark, "refreshed")
    landed = {name: build(spark, sf_dir) for name, build in driver_tables.BRONZE.items()}
    early = F.col("source_updated_at") < F.lit("2023-11-15").cast("timestamp_ntz")
    ingestion.run(spark, {name: df.where(early) if name == "product_events" else df for name, df in landed.items()}, lake)
    refresh.refresh(spark, lake, root, AS_OF)
    ingestion.run(spark, landed, lake, since="2023-11-15 00:00:00")
    refresh.refresh(spark, lake, root, AS_OF)
    return refresh.opened(spark, root)


def ingest_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily activity of the warehouse brought up to date."""
    return backfilled_warehouse(spark, sf_dir)["int_user_activity"]


def ingest_backfill_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per model of the warehouse brought up to date."""
    return refresh.row_counts(backfilled_warehouse(spark, sf_dir))


def ingest_backfill_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention in the warehouse brought up to date, from the weeks kept per month."""
    return backfilled_warehouse(spark, sf_dir)["fct_retention"]


def ingest_backfill_adoption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature adoption in the warehouse brought up to date; only weeks in reach of new events were rewritten."""
    return backfilled_warehouse(spark, sf_dir)["fct_feature_adoption"]


def ingest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per bronze table after a first load, the rest, and everything once more."""
    root = new_folder(spark, "bronze")
    landed = {name: build(spark, sf_dir) for name, build in driver_tables.BRONZE.items()}
    early = F.col("source_updated_at") < F.lit("2023-12-01").cast("timestamp_ntz")
    ingestion.run(spark, {name: df.where(early) for name, df in landed.items()}, root)
    ingestion.run(spark, landed, root, since="2023-12-01 00:00:00")
    ingestion.run(spark, landed, root)
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in read_bronze(spark, root).items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _merged_query(name: str) -> Query:
    """A collection after a first load and a second one that holds everything: each key once, as last written."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, source = new_folder(spark, "bronze"), driver_tables.BRONZE[name](spark, sf_dir)
        ingestion.load(spark, name, source.where(F.col("source_updated_at") < F.lit("2023-12-01").cast("timestamp_ntz")), root)
        ingestion.load(spark, name, source, root)
        return committed.read(spark, f"{root}/bronze/{name}", schemas.BRONZE[name])
    return query


MERGED = ["crm_deals", "billing_customers", "billing_prices", "billing_subscriptions", "billing_invoices"]


def write_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of the built warehouse."""
    return refresh.row_counts(stored_warehouse(spark, sf_dir).build())


# streaming

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern, as a stream takes a plain path for a folder and this may be a file
    path = f"{sf_dir}/event[s].parquet"
    return driver_tables.events_from(jobs.read_stream(spark, path, driver_tables.SCHEMAS["events"]))


def _events_in_batches(spark: SparkSession, sf_dir: str, job: Callable[[DataFrame, str, str], None], name: str) -> str:
    """Runs the job over three landings in turn; deliveries of an event fall into different ones, late ones first."""
    path = new_folder(spark, name)
    events = driver_tables.product_events(spark, sf_dir)
    for part in (2, 0, 1):
        landing_part = F.pmod(F.xxhash64("event_id", "load_id", "source_updated_at"), F.lit(3)) == part
        events.where(landing_part).write.mode("append").parquet(f"{path}/landed")
        job(jobs.read_stream(spark, f"{path}/landed", schemas.PRODUCT_EVENTS), f"{path}/table", f"{path}/checkpoint")
    return f"{path}/table"


def stream_bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "stream-bronze")
    jobs.append_events(_event_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table").drop("event_date", "batch_id")


def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.resolved_events(spark, _events_in_batches(spark, sf_dir, jobs.dedup_events, "stream-dedup"))


def stream_upsert_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of the first load, then those of the second, as landed folders read by one stream."""
    path = new_folder(spark, "stream-upsert")
    for batch in driver_tables.company_batches(spark, sf_dir):
        batch.write.mode("append").parquet(f"{path}/landed")
        stream = jobs.read_stream(spark, f"{path}/landed", schemas.CRM_COMPANIES)
        jobs.upsert_entities(stream, "company_id", f"{path}/table", f"{path}/checkpoint")
    return jobs.current_entities(spark, f"{path}/table")


def stream_daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.current_activity(spark, _events_in_batches(spark, sf_dir, jobs.daily_activity, "stream-activity"))


# scalar rules

def _spellings(df: DataFrame, column: str, standard) -> DataFrame:
    return df.groupBy(F.col(column).alias("spelling")).agg(F.count(F.lit(1)).alias("n")).select(
        "spelling", standard("spelling").alias("standard"), "n")


def std_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spellings(driver_tables.crm_companies(spark, sf_dir), "country", standardise.standard_country)


def std_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spellings(driver_tables.billing_prices(spark, sf_dir), "plan", standardise.standard_plan)


def std_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spellings(
        driver_tables.billing_prices(spark, sf_dir), "billing_frequency", standardise.standard_frequency)


def _event_days(spark: SparkSession, sf_dir: str, name: str, rule) -> DataFrame:
    """The rule's value per day of the event stream, with the day's deliveries."""
    days = driver_tables.product_events(spark, sf_dir).groupBy(F.to_date("event_at").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    return days.select("day", rule("day").alias(name), "n")


def date_year_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_days(spark, sf_dir, "year", F.year)


def date_month_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_days(spark, sf_dir, "month", F.month)


def date_trunc_to_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_days(spark, sf_dir, "month_start", semantics.month_start)


def week_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_days(spark, sf_dir, "week_start", semantics.week_start)


# audiences from sketches

@lru_cache(maxsize=4)
def stored_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches per day and dimensions, written once per session."""
    path, sketches = new_folder(spark, "sketches"), audience.day_sketches(stored_warehouse(spark, sf_dir))
    sketches.write.parquet(path)
    return spark.read.schema(sketches.schema).parquet(path)


def dau_wau_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.dau_wau_sketched(stored_warehouse(spark, sf_dir), stored_sketches(spark, sf_dir))


def dau_by_country_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience.dau_by_country_sketched(stored_warehouse(spark, sf_dir), stored_sketches(spark, sf_dir))


# models and checks

def scd2_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.record_versions(driver_tables.company_batches(spark, sf_dir), "company_id")


def dim_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature dimension with the events counted for each feature."""
    w = warehouse(spark, sf_dir)
    used = w["int_feature_usage"].groupBy("feature_code").agg(F.sum("event_count").alias("event_count"))
    return w["dim_features"].join(used, "feature_code", "left").select(
        "feature_code", "feature_name", F.coalesce("event_count", F.lit(0)).alias("event_count"))


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event ids delivered more than once, as bronze has them."""
    return quality.unique(driver_tables.product_events(spark, sf_dir), "event_id")


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(warehouse(spark, sf_dir)["dim_accounts"], "company_id")


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_range(warehouse(spark, sf_dir)["stg_billing_prices"], "unit_amount", 5, 15)


def dq_generic_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_generic_results(stored_warehouse(spark, sf_dir), list(STAGING))


def dq_generic_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_generic_results(stored_warehouse(spark, sf_dir).keep("int_subscription_history"), list(CORE))


def dq_generic_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_generic_results(stored_warehouse(spark, sf_dir).keep("int_subscription_history"), list(MARTS))


def dq_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.grain_results(stored_warehouse(spark, sf_dir).keep("int_subscription_history"))


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(stored_warehouse(spark, sf_dir).keep("int_subscription_history"))


FUNCTIONS: list[Query] = [
    ingest_envelope, ingest_updated_since, ingest_event_range, ingest_keyset_page, ingest_append_watermark,
    ingest_merge_latest, ingest_schema_evolution, ingest_flatten_props, ingest_backfill,
    ingest_backfill_models, ingest_backfill_retention, ingest_backfill_adoption, ingest_run, write_layer,
    stream_bronze_events, stream_dedup_events, stream_upsert_entities,
    stream_daily_activity,
    std_country, std_plan, std_frequency, date_year_of, date_month_of, date_trunc_to_month, week_start,
    dau_wau_sketched, dau_by_country_sketched, scd2_companies, dim_features, dq_unique, dq_not_null, dq_accepted_range,
    dq_generic_staging, dq_generic_core, dq_generic_marts, dq_grains, dq_summary,
]


def _bronze_query(name: str) -> Query:
    return _tuned(driver_tables.BRONZE[name])


def _model_query(name: str) -> Query:
    # a new DataFrame on the same plan: one that has run would hold on to its shuffle files
    return lambda spark, sf_dir: warehouse(spark, sf_dir)[name].select("*")


def _report_query(plan: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(stored_warehouse(spark, sf_dir))


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(_sized(spark, sf_dir), sf_dir)


def all_queries() -> dict[str, Query]:
    named = {f"bronze_{name}": _bronze_query(name) for name in schemas.BRONZE}
    named.update({name: _model_query(name) for name in MODELS})
    for plans in (REPORTS, METRICS, quality.BUSINESS_CHECKS):
        named.update({name: _report_query(plan) for name, plan in plans.items()})
    named.update({f.__name__: _tuned(f) for f in FUNCTIONS})
    named.update({f"ingest_merge_{name}": _tuned(_merged_query(name)) for name in MERGED})
    return named
