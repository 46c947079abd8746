"""How often a load is computed and what a report writes."""

import mini
import pytest
from pyspark.sql import functions as F

from growthlake import registry
from growthlake.operators import dims
from growthlake.plans import ingestion
from growthlake.plans.warehouse import Warehouse
from growthlake.session import PARTITION_BYTES, READ_BYTES
from growthlake.sources import committed, driver_tables
from growthlake.sources.layers import write_table


def test_a_load_is_computed_once(spark, tmp_path, monkeypatch):
    """The first one needs no look at its buckets; a later one is held while it is compared and merged."""
    companies, held = mini.bronze(spark)["crm_companies"], []
    real = ingestion._buckets_changed
    monkeypatch.setattr(ingestion, "_buckets_changed", lambda old, new, key: held.append(new.storageLevel.useDisk) or real(old, new, key))
    ingestion.load(spark, "crm_companies", companies, str(tmp_path))
    assert held == []
    renamed = companies.withColumns({"name": F.lit("new"), "source_updated_at": F.lit("2030-01-01").cast("timestamp_ntz")})
    ingestion.load(spark, "crm_companies", renamed, str(tmp_path))
    assert held == [True]
    path = f"{tmp_path}/bronze/crm_companies"
    got = committed.read_folders(spark, path, committed.latest(spark, path).all_folders())
    assert {r["name"] for r in got.collect()} == {"new"}
    assert got.count() == companies.select("company_id").distinct().count()


def test_tables_without_folders_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    def refused(*_):
        raise AssertionError("a shuffle only for the write")

    monkeypatch.setattr(type(spark.range(1)), "hint", refused)
    assert write_table(spark.range(10), str(tmp_path), "marts", "t").count() == 10
    with pytest.raises(AssertionError):
        write_table(spark.range(10).withColumn("month", F.lit(1)), str(tmp_path), "marts", "t2", "month")


def test_composed_tables_are_written_only_when_kept(spark, tmp_path):
    tables = mini.bronze(spark)
    composed = ["int_subscription_history", "stg_billing_subscriptions", "stg_billing_prices", "stg_billing_customers"]
    w = Warehouse(spark, tables.__getitem__, mini.AS_OF, str(tmp_path), composed)
    rows = sorted(map(repr, w["fct_account_mrr"].collect()))
    written = {p.name for p in tmp_path.glob("build-*/*/*")}
    assert written == {"fct_account_mrr"}
    w.keep("int_subscription_history")["int_subscription_history"].count()
    assert {p.name for p in tmp_path.glob("build-*/*/*")} == written | {"int_subscription_history"}
    whole = Warehouse(spark, tables.__getitem__, mini.AS_OF, str(tmp_path / "whole"))
    assert sorted(map(repr, whole["fct_account_mrr"].collect())) == rows


def test_plans_that_need_no_end_of_a_period_do_not_look_for_it(spark, tmp_path):
    """Whether an account ever paid and its latest plan need neither end nor status; those of an order do."""
    w = registry.warehouse(spark, "/root/testdata/sf0.001")
    history = w["int_subscription_history"]

    def looks_ahead(df):
        return "next_day" in (plan := df._jdf.queryExecution().optimizedPlan().toString()) or plan.count("Join") > 3

    assert looks_ahead(history.select("ended_at"))
    assert not looks_ahead(dims.current_plan(history))
    assert not looks_ahead(history.where(F.col("plan_code") == "pro").select("account_id").distinct())


def test_what_a_task_reads_does_not_grow_with_the_tables(spark, monkeypatch):
    """Shuffles grow with the driver tables instead, in every query."""
    keys = {"spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum"}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        assert driver_tables.input_bytes(spark, "/root/testdata/sf0.001") > 0
        monkeypatch.setattr(driver_tables, "input_bytes", lambda *_: 1000 * PARTITION_BYTES)
        registry.all_queries()["bronze_product_events"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "1000"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(READ_BYTES)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
