"""A refreshed warehouse equals a full build, and leaves alone what changed input can't reach."""

import os

import mini
import pytest
from growthlake.plans import ingestion, refresh
from growthlake.plans.reports import kpis
from growthlake.plans.warehouse import MODELS, Warehouse
from growthlake.sources import committed, schemas
from growthlake.sources.layers import read_bronze

AS_OF = mini.AS_OF


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as_a_full_build(spark, lake, root, as_of=AS_OF, models=tuple(MODELS)):
    full = Warehouse(spark, read_bronze(spark, str(lake)).__getitem__, as_of)
    got = refresh.opened(spark, str(root))
    for name in models:
        assert sorted(got[name].columns) == sorted(full[name].columns), name
        assert rows(got[name].select(*full[name].columns)) == rows(full[name]), name
    return got


def event(event_id, name, account, at, arrival=None, load="0"):
    return (event_id, name, f"usr_{account}", f"acc_{account}", mini.at(at), mini.at(arrival or at), '{"country":"US"}', load)


def land(spark, lake, *events):
    ingestion.load(spark, "product_events", spark.createDataFrame(list(events), schemas.PRODUCT_EVENTS), str(lake))


def first_refresh(spark, tmp_path):
    lake, root = tmp_path / "lake", tmp_path / "warehouse"
    tables = mini.bronze(spark)
    more = spark.createDataFrame([
        event("old_1", "task_created", "a", "2023-10-31 23:00"), event("old_2", "task_completed", "b", "2023-11-02 10:00"),
        event("old_3", "task_created", "d", "2023-12-30 10:00"), event("old_4", "task_created", "d", "2023-12-31 10:00"),
        event("stray", "task_created", "c", "2023-12-05 10:00", "2023-12-06 10:00"),
    ], schemas.PRODUCT_EVENTS)
    tables["product_events"] = tables["product_events"].unionByName(more)
    ingestion.run(spark, tables, str(lake))
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    return lake, root


def folders(spark, root, name):
    found = committed.latest(spark, str(root)).folders
    return {k.partition("/")[2]: f for k, f in found.items() if k.startswith(f"{name}/")}


def test_all_models_after_each_kind_of_change(spark, tmp_path):
    lake, root = first_refresh(spark, tmp_path)
    # a late event, one of a new account, a repeated delivery, and an event that says another month when delivered again
    land(spark, lake, event("late", "task_created", "b", "2024-01-20 10:00", "2024-03-01 00:00"),
         event("new", "account_created", "z", "2024-02-01 10:00", "2024-03-01 00:00"),
         event("evt_5", "task_completed", "a", "2024-01-01 15:15", "2024-03-02 00:00", "9"),
         event("stray", "task_created", "c", "2024-02-05 10:00", "2024-03-03 00:00"))
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    got = same_as_a_full_build(spark, lake, root)
    assert [r.event_at for r in got["stg_product_events"].where("event_id = 'stray'").collect()] == [mini.at("2023-12-05 10:00")]
    # February again: the stray's other delivery must still not count, though December is not looked at
    land(spark, lake, event("feb", "task_created", "a", "2024-02-07 10:00", "2024-03-04 00:00"))
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    same_as_a_full_build(spark, lake, root, models=["stg_product_events", "fct_product_events", "fct_feature_adoption"])
    # records: a company takes over an account, a subscription ends
    company = spark.createDataFrame([("cmp_z", "acc_z", "Z", "SaaS", "1-10", "US", "organic", "lead", mini.at("2024-03-05 00:00"))],
                                    schemas.CRM_COMPANIES)
    ingestion.load(spark, "crm_companies", company, str(lake))
    ended = read_bronze(spark, str(lake))["billing_subscriptions"].limit(1)
    ended = ended.withColumns({"status": refresh.F.lit("canceled"), "ended_at": refresh.F.lit("2024-03-01").cast("timestamp_ntz"),
                               "source_updated_at": refresh.F.lit("2024-03-06").cast("timestamp_ntz")})
    ingestion.load(spark, "billing_subscriptions", ended, str(lake))
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    got = same_as_a_full_build(spark, lake, root)
    assert kpis(got).count() == 1
    # another day: only what looks at the date changes
    before = committed.latest(spark, str(root)).folders
    refresh.refresh(spark, str(lake), str(root), "2024-05-01")
    same_as_a_full_build(spark, lake, root, "2024-05-01", ["fct_account_mrr", "fct_usage_expansion", "fct_churn"])
    after = committed.latest(spark, str(root)).folders
    assert {k.partition("/")[0] for k in after if after[k] != before.get(k)} <= {"fct_account_mrr", "fct_usage_expansion"}
    # nothing new: nothing written
    assert refresh.refresh(spark, str(lake), str(root), "2024-05-01") is None
    before = {name: refresh.opened(spark, str(root))[name].count() for name in MODELS}
    assert committed.vacuum(spark, str(root), keep=1)
    assert {name: refresh.opened(spark, str(root))[name].count() for name in MODELS} == before


def damage(folder):
    hit = 0
    for d, _, names in os.walk(folder):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(d, n), "w") as f:
                    f.write("unreadable")
                hit += 1
    return hit


def test_untouched_months_are_neither_read_nor_rewritten(spark, tmp_path):
    lake, root = first_refresh(spark, tmp_path)
    big = ["stg_product_events", "int_user_activity", "fct_product_events", "int_feature_usage", "fct_feature_adoption",
           "int_account_usage", "fct_user_daily_activity", "fct_usage_expansion"]
    before = {name: folders(spark, root, name) for name in big}
    land(spark, lake, event("late", "task_created", "b", "2024-01-20 10:00", "2024-03-01 00:00"))
    # October and November may be anything now: bronze, staging, activity, usage and facts
    hit = sum(damage(d) for d, _, _ in os.walk(tmp_path) if d.endswith(("2023-10", "2023-11")) and not any(
        f"/{small}/" in f"{d}/" for small in (refresh.SPANS, refresh.SIGNALS, refresh.WEEKS)))
    assert hit > 6
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    for name in big:
        after = folders(spark, root, name)
        same = {m for m in before[name] if after[m] == before[name][m]}
        assert {"2023-10", "2023-11"} & set(before[name]) <= same, name
    assert folders(spark, root, "stg_product_events")["2024-01"] != before["stg_product_events"]["2024-01"]
    # the account's identity did not change, so other months of its facts stay
    assert folders(spark, root, "fct_product_events")["2023-12"] == before["fct_product_events"]["2023-12"]


def test_a_killed_refresh_leaves_the_last_state(spark, tmp_path):
    lake, root = first_refresh(spark, tmp_path)
    models = ["fct_retention", "fct_product_events", "int_user_activity"]
    before = {name: rows(refresh.opened(spark, str(root))[name]) for name in models}
    land(spark, lake, event("late", "task_created", "b", "2024-01-20 10:00", "2024-03-01 00:00"))
    with pytest.MonkeyPatch.context() as patch:
        def killed(*_):
            raise RuntimeError("killed")
        patch.setattr(refresh.Refresh, "_expand_usage", killed)
        with pytest.raises(RuntimeError, match="killed"):
            refresh.refresh(spark, str(lake), str(root), AS_OF)
    assert {name: rows(refresh.opened(spark, str(root))[name]) for name in models} == before
    refresh.refresh(spark, str(lake), str(root), AS_OF)
    same_as_a_full_build(spark, lake, root, models=models)


def test_nothing_to_open(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        refresh.opened(spark, str(tmp_path))
