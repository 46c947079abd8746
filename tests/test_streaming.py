"""Streams land in the same tables as batch runs, also over several runs and after a repeated batch."""

from functools import reduce

import mini
import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlake.operators.core import int_user_activity
from growthlake.operators.ingest import delivery_order, first_per_key, merge_latest
from growthlake.operators.staging import stg_product_events
from growthlake.sources import committed, schemas
from growthlake.streaming import jobs, unique


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def halves(spark):
    """First what arrived up to the evening of 1 January, then the rest with the repeat and the late event."""
    events = mini.events(spark)
    early = "source_updated_at < timestamp_ntz'2024-01-01 18:00:00'"
    return events.where(early), events.where(f"NOT {early}")


def test_append_keeps_every_delivery_once(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / n) for n in ("landed", "table", "checkpoint"))
    for part in halves(spark):
        land(part, landed)
        jobs.append_events(jobs.read_stream(spark, landed, schemas.PRODUCT_EVENTS), table, checkpoint)
    jobs.append_events(jobs.read_stream(spark, landed, schemas.PRODUCT_EVENTS), table, checkpoint)
    got = spark.read.parquet(table).select(*mini.events(spark).columns)
    assert rows(got) == rows(mini.events(spark))


def run_dedup(spark, tmp_path, parts, checkpoint="checkpoint"):
    landed, table = str(tmp_path / "landed"), str(tmp_path / "table")
    for part in parts:
        land(part, landed)
        jobs.dedup_events(jobs.read_stream(spark, landed, schemas.PRODUCT_EVENTS), table, str(tmp_path / checkpoint))
    return table


def stream_equals_batch(spark, table, events):
    resolved = jobs.resolved_events(spark, table)
    assert rows(stg_product_events(resolved)) == rows(stg_product_events(events))
    assert resolved.count() == events.select("event_id").distinct().count()


def changed(event, **values):
    return event.withColumns({name: F.lit(value).cast(event.schema[name].dataType) for name, value in values.items()})


def test_dedup_over_runs_keeps_the_first_delivery(spark, tmp_path):
    stream_equals_batch(spark, run_dedup(spark, tmp_path, halves(spark)), mini.events(spark))


def test_a_repeat_that_says_another_day_counts_once(spark, tmp_path):
    events = mini.events(spark)
    repeat = changed(events.where("event_id = 'evt_2'").limit(1), event_at="2024-03-04 05:00:00",
                     source_updated_at="2024-03-05 00:00:00", load_id="9")
    stream_equals_batch(spark, run_dedup(spark, tmp_path, [events, repeat]), events.unionByName(repeat))


def test_an_earlier_delivery_that_lands_later_wins(spark, tmp_path):
    events = mini.events(spark)
    earlier = changed(events.where("event_id = 'evt_2'").limit(1), source_updated_at="2023-12-31 00:00:00", load_id="0")
    table = run_dedup(spark, tmp_path, [events, earlier])
    stream_equals_batch(spark, table, events.unionByName(earlier))
    assert str(jobs.resolved_events(spark, table).where("event_id = 'evt_2'").first().source_updated_at).startswith("2023-12-31")


def test_deliveries_that_differ_in_properties_only_resolve_alike(spark, tmp_path):
    events = mini.events(spark)
    twin = changed(events.where("event_id = 'evt_2'").limit(1), properties='{"country": "ZZ"}')
    for name, parts in (("a", [events, twin]), ("b", [twin, events])):
        stream_equals_batch(spark, run_dedup(spark, tmp_path / name, parts), events.unionByName(twin))


def test_a_new_checkpoint_over_a_table_is_refused(spark, tmp_path):
    table = run_dedup(spark, tmp_path, halves(spark))
    with pytest.raises(ValueError, match="another checkpoint"):
        run_dedup(spark, tmp_path, [mini.events(spark)], "second")
    stream_equals_batch(spark, table, mini.events(spark))


def files(root):
    return {p for p in root.rglob("*") if p.is_file()}


def forget_last_batch(tmp_path, batch):
    """The checkpoint forgets that a batch ended, as after a failure between write and commit."""
    for name in (f"{batch}", f".{batch}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = run_dedup(spark, tmp_path, halves(spark))
    before = files(tmp_path / "table")
    forget_last_batch(tmp_path, 1)
    jobs.dedup_events(
        jobs.read_stream(spark, str(tmp_path / "landed"), schemas.PRODUCT_EVENTS), table, str(tmp_path / "checkpoint"))
    assert files(tmp_path / "table") == before


def events_like(spark, numbers, at, load="0", name="task_created", user="u"):
    rows_ = [(f"e{i}", name, f"{user}{i % 7}", f"acc_{i % 3}", mini.at(at), mini.at(at), "{}", load) for i in numbers]
    return spark.createDataFrame(rows_, schemas.PRODUCT_EVENTS)


def batches(spark):
    """Many small batches: new events, repeats of far older ones, and deliveries that replace earlier ones, some twice."""
    out = [events_like(spark, range(20 * k, 20 * k + 25), f"2024-01-{k + 1:02d} 10:00:00") for k in range(12)]
    out.append(events_like(spark, range(0, 240, 9), "2023-12-30 10:00:00", "r", "task_completed", "v"))
    out.append(events_like(spark, range(0, 240, 18), "2023-12-20 10:00:00", "s"))
    out.append(events_like(spark, range(0, 240, 5), "2024-03-20 10:00:00", "t"))
    return out


def test_runs_are_merged_and_reads_rank_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(unique, "FANOUT", 3)
    table, landed = str(tmp_path / "table"), batches(spark)
    for n, batch in enumerate(landed):
        unique.UniqueEvents(spark, table, schemas.PRODUCT_EVENTS).add(batch, n)
    got = unique.UniqueEvents(spark, table, schemas.PRODUCT_EVENTS)
    assert len(got.rows) < 9
    every = reduce(DataFrame.unionByName, landed)
    assert rows(got.read()) == rows(first_per_key(every, ["event_id"], delivery_order()))
    plan = got.read()._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    committed.vacuum(spark, table, keep=1)
    assert rows(unique.read_unique(spark, table, schemas.PRODUCT_EVENTS)) == rows(
        first_per_key(every, ["event_id"], delivery_order()))


def test_a_batch_meets_only_index_files_that_may_know_its_ids(spark, tmp_path):
    table = unique.UniqueEvents(spark, str(tmp_path / "table"), schemas.PRODUCT_EVENTS)
    for n in range(3):
        table.add(events_like(spark, range(100 * n, 100 * n + 100), f"2024-01-0{n + 1} 10:00:00"), n)
    filters = table._read(table._run_folders("filters"), "run string, bucket int, bits binary")
    met = unique._candidates(events_like(spark, [150], "2024-02-01 10:00:00"), filters, unique.BUCKETS).collect()
    second = table.runs[1]
    assert second in {r.run for r in met} and len(met) < 3
    # the other runs' index may be unreadable
    for run in table.runs:
        if run not in {r.run for r in met}:
            for p in (tmp_path / "table" / "data" / run / "ids").rglob("*.parquet"):
                p.write_text("unreadable")
    table.add(events_like(spark, [150], "2024-02-01 10:00:00"), 3)
    assert table.read().count() == 300


def test_filters_know_all_their_ids():
    keys = np.random.default_rng(2).integers(-(1 << 62), 1 << 62, (2, 4000))
    bits = unique.bloom_bits(*keys[:, :2000])
    assert unique.may_hold(bits, *keys[:, :2000]).all()
    assert unique.may_hold(bits, *keys[:, 2000:]).mean() < 0.03


def test_activity_follows_each_batch(spark, tmp_path):
    """Counts equal the batch job's after every batch; a batch that died between the two tables is taken up."""
    table, seen = str(tmp_path / "table"), []
    for n, batch in enumerate(batches(spark)[-6:]):
        seen.append(batch)
        events = unique.UniqueEvents(spark, table, schemas.PRODUCT_EVENTS)
        events.add(batch, n)
        if n == 3:
            # dies here; the batch comes again
            events = unique.UniqueEvents(spark, table, schemas.PRODUCT_EVENTS)
            events.add(batch, n)
        for _ in range(2):
            unique.count_changes(events, f"{table}/daily")
        if n in (1, 3, 4, 5):
            expected = int_user_activity(stg_product_events(reduce(DataFrame.unionByName, seen)))
            got = unique.read_activity(spark, f"{table}/daily")
            assert rows(got.select(*expected.columns)) == rows(expected)
    # days that the last batch did not touch stay as they were
    folders = committed.latest(spark, f"{table}/daily").folders
    assert len({f[0].split("/")[1] for f in folders.values()}) > 1


def test_activity_counts_anew_where_batches_were_not_counted(spark, tmp_path):
    table, (one, two, three) = str(tmp_path / "table"), batches(spark)[:3]
    for n, batch in enumerate((one, two, three)):
        events = unique.UniqueEvents(spark, table, schemas.PRODUCT_EVENTS)
        events.add(batch, n)
    unique.count_changes(events, f"{table}/daily")
    expected = int_user_activity(stg_product_events(one.unionByName(two).unionByName(three)))
    assert rows(unique.read_activity(spark, f"{table}/daily").select(*expected.columns)) == rows(expected)


def test_upserts_equal_a_merge(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / n) for n in ("landed", "table", "checkpoint"))
    loads = mini.company_loads(spark)
    for load in loads:
        land(load, landed)
        jobs.upsert_entities(jobs.read_stream(spark, landed, schemas.CRM_COMPANIES), "company_id", table, checkpoint)
    assert rows(jobs.current_entities(spark, table)) == rows(merge_latest(loads, "company_id"))


def test_upserts_are_a_bronze_table(spark, tmp_path):
    """One stream, two runs and a repeated batch; the bronze reader sees the newest rows."""
    path, landed = f"{tmp_path}/bronze/crm_companies", str(tmp_path / "landed")
    loads = mini.company_loads(spark)
    for load in loads:
        land(load, landed)
        stream = jobs.read_stream(spark, landed, schemas.CRM_COMPANIES)
        jobs.upsert_entities(stream, "company_id", path, str(tmp_path / "checkpoint"))
    before = files(tmp_path / "bronze")
    forget_last_batch(tmp_path, 1)
    jobs.upsert_entities(jobs.read_stream(spark, landed, schemas.CRM_COMPANIES), "company_id", path, str(tmp_path / "checkpoint"))
    assert files(tmp_path / "bronze") == before
    assert rows(committed.read(spark, path, schemas.CRM_COMPANIES)) == rows(merge_latest(loads, "company_id"))


def test_daily_activity_equals_batch(spark, tmp_path):
    landed, table, checkpoint = (str(tmp_path / n) for n in ("landed", "table", "checkpoint"))
    for part in halves(spark):
        land(part, landed)
        jobs.daily_activity(jobs.read_stream(spark, landed, schemas.PRODUCT_EVENTS, max_files=1), table, checkpoint)
    expected = int_user_activity(stg_product_events(mini.events(spark)))
    assert rows(jobs.current_activity(spark, table).select(*expected.columns)) == rows(expected)
