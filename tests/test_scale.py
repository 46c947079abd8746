"""Skewed input against brute force, and plans as they should be."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from growthlake.operators.adjacent import with_neighbour
from growthlake.operators.core import int_active_weeks, int_user_activation, int_user_activity
from growthlake.operators.facts import fct_account_mrr, fct_product_events, fct_retention, heavy_accounts, mrr_levels
from growthlake.operators.staging import flatten_properties, stg_product_events
from growthlake.plans import reports
from growthlake.plans.warehouse import Warehouse
from growthlake.registry import all_queries
from growthlake.session import new_folder
from growthlake.sources import driver_tables

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("following", [False, True])
def test_neighbours_of_a_hot_key(spark, following):
    """A third of the rows has one key; null keys and empty hours in between."""
    rng = random.Random(7)
    start = datetime.datetime(2024, 1, 1)
    data = [
        (rng.choice(["hot", "hot", None] + [f"k{i}" for i in range(6)]),
         start + datetime.timedelta(minutes=rng.randrange(60 * 24 * 5)), i)
        for i in range(600)
    ]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id int").repartition(7)
    got = with_neighbour(df, ["k"], F.date_trunc("hour", "t"), ["t", "id"], ["id"], "n", following)
    shift = F.lead if following else F.lag
    plain = df.withColumn("n", shift("id").over(Window.partitionBy("k").orderBy("t", "id")))
    assert sorted(map(repr, got.select("id", "n.id").collect())) == sorted(
        repr(r) for r in plain.select("id", F.col("n").alias("id")).collect())


def test_weekly_audience_against_brute_force(spark):
    rng = random.Random(3)
    base = datetime.date(2024, 1, 1)
    pairs = {(rng.choice(["hot"] * 10 + [f"u{i}" for i in range(20)]), rng.randrange(60)) for _ in range(300)}
    pairs = {p for p in pairs if not 20 <= p[1] < 35}
    activity = spark.createDataFrame(
        [(u, f"a{i % 2}", base + datetime.timedelta(d)) for u, d in pairs for i in range(2)],
        "user_id string, account_id string, activity_date date")
    got = {r.activity_date: (r.dau, r.wau) for r in reports.dau_wau({"fct_user_daily_activity": activity}).collect()}
    expected = {}
    for day in {d for _, d in pairs}:
        users = {u for u, d in pairs if d == day}
        week = {u for u, d in pairs if day - 6 <= d <= day}
        expected[base + datetime.timedelta(day)] = (len(users), len(week))
    assert got == expected


def test_one_account_and_one_event_with_a_third_of_all_rows(spark):
    events = driver_tables.product_events(spark, SF)
    n = events.count()
    one = events.limit(1).crossJoin(spark.range(n // 2)).drop("id")
    hot = events.withColumns({
        "account_id": F.lit("acc_hot"), "event_id": F.concat(F.lit("hot_"), F.col("event_id"))})
    skewed = stg_product_events(events.unionByName(one).unionByName(hot))
    plain = stg_product_events(events)
    assert skewed.count() == 2 * plain.count()
    # the other accounts come out as without the hot ones
    for model in (int_user_activation, int_user_activity):
        rest = model(skewed).where("account_id <> 'acc_hot'")
        assert rest.exceptAll(model(plain)).count() == 0 and rest.count() == model(plain).count()


def with_hot_account(spark):
    """The events of sf0.01, and as many of one account more."""
    events = driver_tables.product_events(spark, "/root/testdata/sf0.01")
    hot = events.withColumns({"account_id": F.lit("acc_hot"), "event_id": F.concat(F.lit("hot_"), F.col("event_id"))})
    path = new_folder(spark, "skew")
    events.unionByName(hot).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return before


# every join is a merge, and AQE can neither split nor join partitions
NO_HELP = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_a_hot_account_is_split_over_tasks(spark):
    """The registered model over a hot account, with no help of AQE: no task has twice the rows of the median one."""
    deliveries = with_hot_account(spark)
    tables = {name: build(spark, "/root/testdata/sf0.01") for name, build in driver_tables.BRONZE.items()}
    tables["product_events"] = deliveries
    w = Warehouse(spark, tables.__getitem__, driver_tables.AS_OF)
    staged, identity = stg_product_events(deliveries), w["int_identity_mapping"]
    expected = staged.join(identity, "account_id", "left").select("event_id", "account_id", "company_id", "customer_id")
    expected = sorted(map(repr, expected.collect()))
    before = settings(spark, NO_HELP)
    try:
        joined = w["fct_product_events"]
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        got = sorted(map(repr, joined.select("event_id", "account_id", "company_id", "customer_id").collect()))
    finally:
        settings(spark, before)
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[4]
    assert got == expected


def test_heavy_accounts_are_few_and_change_no_row(spark):
    deliveries = with_hot_account(spark)
    assert [r.account_id for r in heavy_accounts(deliveries, 0.3).collect()] == ["acc_hot"]
    staged = flatten_properties(deliveries.limit(2000))
    identity = staged.where("account_id IS NOT NULL").select("account_id").distinct().withColumns({
        "company_id": F.concat(F.lit("cmp_"), F.col("account_id")), "customer_id": F.lit(None).cast("string")})
    none = heavy_accounts(deliveries, 0.3).limit(0)
    every = staged.select("account_id").distinct().where("account_id IS NOT NULL")
    outcomes = [sorted(map(repr, fct_product_events(staged, identity, h).collect())) for h in (none, every, None)]
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_activation_scans_events_twice(spark):
    path = new_folder(spark, "staged")
    stg_product_events(driver_tables.product_events(spark, SF)).write.parquet(path)
    df = int_user_activation(spark.read.parquet(path))
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the first pass serves two uses, by one exchange
    assert ran.count("FileScan") == 2 and "ReusedExchange" in ran


def test_a_subscription_without_end_in_sight_is_two_rows_before_the_sum(spark):
    """An end in the year 9999: the running sum sees two changes, and the months appear only in the result."""
    history = spark.createDataFrame(
        [("acc", "2024-01-10", "9999-12-31", 2, 10.0), ("acc", "2024-03-01", None, 1, 5.0)],
        "account_id string, effective_at string, ended_at string, seats int, monthly_unit_amount double")
    history = history.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("effective_at", "ended_at")})
    levels = mrr_levels(history, ["account_id"], "2024-04-15").orderBy("first_month").collect()
    assert [(str(r.first_month), str(r.last_month), r.mrr, r.mrr_before) for r in levels] == [
        ("2024-01-01", "2024-02-01", 20.0, None), ("2024-03-01", "2024-04-01", 25.0, 20.0),
        ("2024-05-01", "9999-12-01", 20.0, 25.0)]
    months = fct_account_mrr(history, "2024-04-15").where("mrr_month < date'2024-07-01'").orderBy("mrr_month").collect()
    assert [(r.mrr, r.expansion_mrr) for r in months] == [(20.0, 0.0), (20.0, 0.0), (25.0, 5.0), (25.0, 0.0), (20.0, 0.0), (20.0, 0.0)]


def test_week_bitmaps_equal_sets_of_weeks(spark):
    """Weeks about the edges of words, before the first numbered one, and without a date."""
    draw = random.Random(3)
    base = datetime.date(1970, 1, 4)
    rows = [(f"a{draw.randrange(6)}", base + datetime.timedelta(draw.randrange(-500, 1500))) for _ in range(300)]
    rows += [("a1", None), ("a1", None), (None, base)]
    activity = spark.createDataFrame(rows, "account_id string, activity_date date")
    words = int_active_weeks(activity)
    weeks = {}
    for a, d in rows:
        weeks.setdefault(a, set()).add(d and (d - base).days // 7)
    counted = words.groupBy("account_id").agg(F.sum(F.bit_count("weeks")).alias("n")).collect()
    assert {r.account_id: r.n for r in counted} == {a: len(w) for a, w in weeks.items()}
    signups = [(f"a{k}", base + datetime.timedelta(draw.randrange(-400, 1400))) for k in range(6)] + [("none", base)]
    got = fct_retention(spark.createDataFrame(signups, "account_id string, signup_at date"), words).collect()
    last = max(n for w in weeks.values() for n in w if n is not None)
    expected = {}
    for a, at in signups:
        begun = (at - base).days // 7
        for k in range(min(12, max(0, last - begun)) + 1):
            size, kept = expected.get((begun, k), (0, 0))
            expected[begun, k] = (size + 1, kept + (begun + k in weeks.get(a, ())))
    assert {((r.cohort_week - base).days // 7, r.week_offset): (r.cohort_size, r.retained_accounts) for r in got} == expected


def test_dedup_cuts_rows_before_the_shuffle(spark):
    plan = plan_of(all_queries()["int_user_activity"](spark, SF))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_scans_read_only_needed_columns_and_push_filters(spark):
    plan = plan_of(all_queries()["fct_user_journey"](spark, SF))
    assert "value" not in plan.split("ReadSchema: ")[1].split("\n")[0]
    companies = plan_of(driver_tables.company_batches(spark, SF)[0].where("industry = 'BUILDING'"))
    assert "EqualTo(c_mktsegment,BUILDING)" in companies


def test_no_query_multiplies_rows_or_leaves_the_jvm(spark):
    names = [n for n in all_queries() if n.startswith(("int_", "dim_", "fct_", "stg_", "bronze_"))]
    for name in names:
        plan = plan_of(all_queries()[name](spark, SF))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
            assert operator not in plan, (name, operator)
