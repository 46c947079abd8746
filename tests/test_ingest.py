"""Ingestion: watermarks, pages, merging, evolving shapes, landed files."""

import json
import random

from pyspark.sql import functions as F

import mini
from growthlake.operators import ingest
from growthlake.operators.staging import stg_product_events
from growthlake.plans import ingestion
from growthlake.sources import committed, landing, layers, schemas


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_updated_since_includes_the_watermark(spark):
    df = ingest.updated_since(mini.events(spark), "2024-01-10 08:00:00")
    assert sorted(r.event_id for r in df.collect()) == ["evt_13", "evt_14"]


def test_event_range_is_half_open(spark):
    df = ingest.event_range(mini.events(spark), "2024-01-10 08:00:00", "2024-01-11 08:00:00")
    assert [r.event_id for r in df.collect()] == ["evt_13"]


def test_event_range_prunes_folders(spark, tmp_path):
    dated = mini.events(spark).withColumn("event_date", F.to_date("event_at"))
    stored = layers.write_table(dated, str(tmp_path), "bronze", "product_events", "event_date")
    df = ingest.event_range(stored, "2024-01-02 00:00:00", "2024-01-04 00:00:00")
    assert sorted(r.event_id for r in df.collect()) == ["evt_10", "evt_12"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_pages_walk_the_whole_table_once(spark):
    events, keys = mini.events(spark), ["source_updated_at", "event_id", "load_id"]
    seen, after = [], None
    while True:
        page = ingest.keyset_page(events, keys, after, 4).collect()
        seen += [(r.event_id, r.load_id) for r in page]
        if len(page) < 4:
            break
        after = tuple(page[-1][k] for k in keys)
    assert len(seen) == len(set(seen)) == events.count()


def test_append_repeats_nothing_and_loses_nothing(spark):
    source = mini.events(spark)
    existing = source.where(F.col("source_updated_at") <= F.lit("2024-01-01 09:35:00").cast("timestamp_ntz"))
    watermark = ingest.high_watermark(existing).first().watermark
    added = ingest.append_incremental(existing, source, watermark)
    assert rows(existing.unionByName(added)) == rows(source)
    # two events lie on the watermark; one that arrives there later is still taken
    assert existing.where(F.col("source_updated_at") == F.lit(watermark)).count() == 1
    late = source.limit(1).withColumns({
        "event_id": F.lit("evt_new"), "source_updated_at": F.lit("2024-01-01 09:35:00").cast("timestamp_ntz")})
    again = ingest.append_incremental(source, source.unionByName(late), watermark)
    assert "evt_new" in {r.event_id for r in again.collect()}


def test_merge_is_idempotent_and_ignores_row_order(spark):
    first, second = mini.company_loads(spark)
    once = rows(ingest.merge_latest([first, second], "company_id"))
    assert rows(ingest.merge_latest([first, second, first], "company_id")) == once
    assert rows(ingest.merge_latest([ingest.merge_latest([first, second], "company_id"), second], "company_id")) == once
    assert {(r[0], r[7]) for r in once} == {("cmp_a", "customer"), ("cmp_b", "lead"), ("cmp_d", "churned")}


def test_later_load_wins_a_tie(spark):
    first, _ = mini.company_loads(spark)
    renamed = first.withColumn("name", F.lit("new"))
    assert {r.name for r in ingest.merge_latest([first, renamed], "company_id").collect()} == {"new"}


def test_union_of_shapes(spark):
    prices = ingest.union_evolved(mini.price_shapes(spark))
    assert {r.price_id: r.plan_code for r in prices.collect()} == {
        "prc_free": None, "prc_pro": None, "prc_ent": "enterprise", "prc_ent_year": "ENT"}


def test_dedup_ignores_row_order_and_runs_twice(spark):
    collected = mini.events(spark).collect()
    expected = rows(stg_product_events(mini.events(spark)))
    random.Random(1).shuffle(collected)
    shuffled = spark.createDataFrame(collected, schemas.PRODUCT_EVENTS).repartition(5)
    assert rows(stg_product_events(shuffled)) == expected
    assert rows(stg_product_events(shuffled.unionByName(shuffled))) == expected


def test_backfill_twice_is_the_same(spark):
    source = mini.events(spark)
    once = ingest.backfill(source, source, "2024-01-03 00:00:00")
    assert rows(ingest.backfill(once, source, "2024-01-03 00:00:00")) == rows(source)


def test_landed_pages(spark, tmp_path):
    page = ('{"data": [{"event_id": "e1", "event_name": "x", "distinct_id": "u", "account_id": "a", '
            '"event_at": "2024-01-01T09:00:00", "source_updated_at": "2024-01-01T09:00:00.000123", '
            '"properties": {"k": 1, "b": {"c": 2}}}, {"event_id": "e2"}], "next_cursor": "n"}\n'
            '{"data": [], "next_cursor": null}\n')
    (tmp_path / "page.json").write_text(page)
    got = landing.read_pages(spark, str(tmp_path), schemas.PRODUCT_EVENTS).orderBy("event_id").collect()
    assert [r.event_id for r in got] == ["e1", "e2"]
    assert got[0].source_updated_at == mini.at("2024-01-01 09:00:00.000123")
    assert json.loads(got[0].properties) == {"k": 1, "b": {"c": 2}} and got[0].load_id is None


def test_pages_written_and_read_back(spark, tmp_path):
    path = str(tmp_path / "pages")
    landing.write_pages(mini.events(spark), path, size=3)
    assert rows(landing.read_pages(spark, path, schemas.PRODUCT_EVENTS)) == rows(mini.events(spark))


def test_bronze_tables_and_views(spark, tmp_path):
    for name, df in mini.bronze(spark).items():
        layers.write_table(df, str(tmp_path), "bronze", name)
    tables = layers.read_bronze(spark, str(tmp_path))
    layers.register_views(tables, "bronze_")
    assert spark.sql("SELECT count(*) FROM bronze_product_events").first()[0] == 16
    assert tables["billing_prices"].where("plan_code IS NULL").count() == 2


def test_bronze_equals_the_source_after_full_incremental_and_repeated_loads(spark, tmp_path):
    tables, root = mini.bronze(spark), str(tmp_path)
    early = F.col("source_updated_at") < F.lit("2024-01-05").cast("timestamp_ntz")
    ingestion.run(spark, {name: df.where(early) for name, df in tables.items()}, root)
    for since in ("2024-01-05 00:00:00", "2024-01-05 00:00:00", None):
        ingestion.run(spark, tables, root, since)
        for name, df in layers.read_bronze(spark, root).items():
            expected = tables[name].select(*[c if c in tables[name].columns else F.lit(None).alias(c) for c in df.columns])
            assert rows(df) == rows(expected), name


def test_a_merge_keeps_the_newest_write_of_all_loads(spark, tmp_path):
    for load in mini.company_loads(spark) + mini.company_loads(spark)[:1]:
        ingestion.load(spark, "crm_companies", load, str(tmp_path))
    stored = committed.read(spark, f"{tmp_path}/bronze/crm_companies", schemas.CRM_COMPANIES)
    merged = ingest.merge_latest(mini.company_loads(spark), "company_id")
    assert rows(stored.select(*merged.columns)) == rows(merged)
