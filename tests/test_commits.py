"""Loads that die at any step, come again, or meet another; merges that leave other buckets alone."""

import os

import mini
import pytest
from growthlake.operators import ingest
from growthlake.plans import ingestion
from growthlake.sources import committed, schemas
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


class Killed(RuntimeError):
    pass


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def read(spark, root, name):
    return committed.read(spark, f"{root}/bronze/{name}", schemas.BRONZE[name])


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def die_before(monkeypatch, place, name):
    def killed(*args, **kwargs):
        raise Killed(name)
    monkeypatch.setattr(place, name, killed)


def die_after(monkeypatch, place, name):
    real = getattr(place, name)

    def killed(*args, **kwargs):
        real(*args, **kwargs)
        raise Killed(name)
    monkeypatch.setattr(place, name, killed)


STEPS = {
    "before the data": (die_before, DataFrameWriter, "parquet"),
    "after the data": (die_after, DataFrameWriter, "parquet"),
    "before the commit": (die_before, committed, "publish"),
    "before its rename": (die_before, committed, "rename_new"),
    "after the commit": (die_after, committed, "publish"),
}


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("name", ["product_events", "crm_companies"])
def test_a_load_killed_at_any_step_loses_and_repeats_nothing(spark, tmp_path, step, name):
    source = mini.bronze(spark)[name]
    early = source.where(F.col("source_updated_at") < F.lit("2024-01-05").cast("timestamp_ntz"))
    ingestion.load(spark, name, early, str(tmp_path))
    before = rows(read(spark, tmp_path, name))
    with pytest.MonkeyPatch.context() as patch:
        kill, place, what = STEPS[step]
        kill(patch, place, what)
        with pytest.raises(Killed):
            ingestion.load(spark, name, source, str(tmp_path))
    whole = rows(source.select(*[c if c in source.columns else F.lit(None).alias(c) for c in read(spark, tmp_path, name).columns]))
    # readers see the old table, or all of the new one
    assert rows(read(spark, tmp_path, name)) == (whole if step == "after the commit" else before)
    for _ in range(2):
        ingestion.load(spark, name, source, str(tmp_path))
        assert rows(read(spark, tmp_path, name)) == whole


def test_a_killed_first_load_leaves_no_table(spark, tmp_path, monkeypatch):
    with pytest.MonkeyPatch.context() as patch:
        die_before(patch, committed, "publish")
        with pytest.raises(Killed):
            ingestion.load(spark, "product_events", mini.events(spark), str(tmp_path))
    assert committed.latest(spark, f"{tmp_path}/bronze/product_events") is None
    ingestion.load(spark, "product_events", mini.events(spark), str(tmp_path))
    assert rows(read(spark, tmp_path, "product_events")) == rows(mini.events(spark))


def test_one_of_two_loads_at_once_is_refused(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/bronze/product_events"
    early = F.col("source_updated_at") < F.lit("2024-01-02").cast("timestamp_ntz")
    ingestion.load(spark, "product_events", mini.events(spark).where(early), root)
    with pytest.MonkeyPatch.context() as patch:
        stale = committed.latest(spark, path)
        ingestion.load(spark, "product_events", mini.events(spark), root)
        patch.setattr(committed, "latest", lambda *_: stale)
        with pytest.raises(committed.CommitConflict):
            ingestion.load(spark, "product_events", mini.events(spark), root)
    assert rows(read(spark, tmp_path, "product_events")) == rows(mini.events(spark))


def delivery(event_id, at, load="l1"):
    return (event_id, "task_created", "u", "a", mini.at("2024-01-01 00:00:00"), at and mini.at(at), None, load)


def load_events(spark, root, *deliveries) -> DataFrame:
    ingestion.load(spark, "product_events", spark.createDataFrame(list(deliveries), schemas.PRODUCT_EVENTS), str(root))
    return read(spark, root, "product_events")


def test_rows_on_the_watermark_and_without_a_cursor(spark, tmp_path):
    first = [delivery("e1", "2024-01-01 00:00:00"), delivery("e2", "2024-01-02 00:00:00"), delivery("e3", None)]
    assert load_events(spark, tmp_path, *first).count() == 3
    # the same again, another delivery of e2 on the watermark, e2 itself twice, and a new row without a cursor
    more = [*first, delivery("e2", "2024-01-02 00:00:00", "l2"), first[1], delivery("e4", None), delivery("e0", "2023-01-01 00:00:00")]
    for _ in range(2):
        got = load_events(spark, tmp_path, *more)
        # e0 lies before the cursor and is not asked for
        assert rows(got) == rows(spark.createDataFrame(more[:-1], schemas.PRODUCT_EVENTS))


def test_a_table_without_any_cursor(spark, tmp_path):
    load_events(spark, tmp_path, delivery("e1", None))
    got = load_events(spark, tmp_path, delivery("e1", None), delivery("e2", "2024-01-02 00:00:00"))
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e2"]


def test_the_cursor_compares_as_a_time(spark, tmp_path):
    path = f"{tmp_path}/bronze/product_events"
    load_events(spark, tmp_path, delivery("e1", "2024-01-01 00:00:00.5"))
    load_events(spark, tmp_path, delivery("e2", "2024-01-01 00:00:01"))
    assert committed.latest(spark, path).cursor == "2024-01-01 00:00:01"


def companies(spark, numbers, name, at):
    rows_ = [(f"cmp_{i}", f"acc_{i}", name, "x", "1-10", "US", "web", "lead", mini.at(at)) for i in numbers]
    return spark.createDataFrame(rows_, schemas.CRM_COMPANIES)


def test_a_merge_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    root, path = str(tmp_path), tmp_path / "bronze" / "crm_companies" / "data"
    first = companies(spark, range(400), "old", "2024-01-01 00:00:00")
    before = ingestion.load(spark, "crm_companies", first, root, buckets=8)
    had = files(path)
    bucketed = first.withColumn("bucket", ingestion.bucket_of("company_id", 8)).where("bucket = 3")
    few = [int(r.company_id[4:]) for r in bucketed.limit(4).collect()]
    second = companies(spark, few, "new", "2024-01-02 00:00:00")
    after = ingestion.load(spark, "crm_companies", second, root)
    assert {b for b in after.folders if after.folders[b] != before.folders[b]} == {"3"}
    assert had.items() <= files(path).items()
    assert rows(read(spark, tmp_path, "crm_companies")) == rows(ingest.merge_latest([first, second], "company_id"))
    # an older or equal write changes no file at all
    had = files(path)
    assert ingestion.load(spark, "crm_companies", second.unionByName(first), root) == after
    assert files(path) == had


def test_a_merge_reads_only_the_buckets_it_meets(spark, tmp_path):
    root = str(tmp_path)
    first = companies(spark, range(100), "old", "2024-01-01 00:00:00")
    commit = ingestion.load(spark, "crm_companies", first, root, buckets=4)
    met = first.withColumn("bucket", ingestion.bucket_of("company_id", 4)).where("bucket = 1").select(*first.columns)
    for bucket, folders in commit.folders.items():
        if bucket != "1":
            for f in folders:
                for d, _, names in os.walk(tmp_path / "bronze" / "crm_companies" / f):
                    for n in names:
                        with open(os.path.join(d, n), "w") as damaged:
                            damaged.write("unreadable")
    ingestion.load(spark, "crm_companies", met.withColumns({
        "name": F.lit("new"), "source_updated_at": F.lit("2024-02-01").cast("timestamp_ntz")}), root)


def test_unknown_columns_of_a_load_stay(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/bronze/crm_companies"
    ingestion.load(spark, "crm_companies", companies(spark, [1], "a", "2024-01-01 00:00:00").withColumn("tier", F.lit("gold")), root)
    commit = ingestion.load(spark, "crm_companies", companies(spark, [1, 2], "b", "2023-01-01 00:00:00"), root)
    got = committed.read_folders(spark, path, commit.all_folders())
    assert {(r.company_id, r["name"], r.tier) for r in got.collect()} == {("cmp_1", "a", "gold"), ("cmp_2", "b", None)}


def test_earlier_versions_and_vacuum(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/bronze/crm_companies"
    for day in (1, 2, 3):
        ingestion.load(spark, "crm_companies", companies(spark, [day, 10], f"n{day}", f"2024-01-0{day} 00:00:00"), root)
    assert committed.read(spark, path, schemas.CRM_COMPANIES, version=1).count() == 2
    os.makedirs(tmp_path / "bronze" / "crm_companies" / "data" / "left-by-a-dead-load")
    now = rows(read(spark, tmp_path, "crm_companies"))
    removed = committed.vacuum(spark, path, keep=1)
    assert "data/left-by-a-dead-load" in removed and len(removed) > 1
    assert rows(read(spark, tmp_path, "crm_companies")) == now
    assert committed.vacuum(spark, path, keep=1) == []
