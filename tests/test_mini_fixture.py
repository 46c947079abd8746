"""Results worked out by hand on the mini fixture."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import mini
from growthlake.operators import dims, facts, quality
from growthlake.operators.history import record_versions
from growthlake.plans import metrics, reports
from growthlake.plans.warehouse import MODELS


@pytest.fixture(scope="module")
def w(spark, tmp_path_factory):
    return mini.warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_repeat_is_dropped_and_the_first_delivery_kept(w):
    assert w["stg_product_events"].count() == 15
    kept = w["stg_product_events"].where("event_id = 'evt_5'").first()
    assert kept.source_updated_at == mini.at("2024-01-01 15:15")
    assert (kept.country, kept.task_id, kept.channel) == ("US", "tsk_1", None)


def test_activation(w):
    assert rows(w["int_user_activation"], "account_id", "is_activated") == [
        ("acc_a", True), ("acc_b", False), ("acc_c", False)]
    a = w["fct_user_activation"].where("account_id = 'acc_a'").first()
    assert a.activation_at == mini.at("2024-01-01 15:15")
    assert (a.time_to_activation_days, a.signup_week, a.signup_month) == (0, date(2023, 12, 31), date(2024, 1, 1))


def test_signal_after_the_window_does_not_count_but_the_journey_has_it(w):
    b = w["int_user_activation"].where("account_id = 'acc_b'").first()
    assert b.task_done_at is None
    assert w["fct_user_journey"].where("account_id = 'acc_b'").first().reached_task_completed


def test_late_event_counts_on_its_day(w):
    day = w["int_user_activity"].where("account_id = 'acc_b' and activity_date = '2024-01-01'").first()
    assert (day.event_count, day.distinct_features) == (2, 2)
    assert rows(metrics.late_events(w).where("late_events > 0"), "day", "late_events") == [(date(2024, 1, 1), 1)]


def test_identity_and_current_plan(w):
    assert rows(w["dim_accounts"], "account_id", "country", "plan_code", "crm_identity_missing") == [
        ("acc_a", "US", "pro", False), ("acc_b", "CA", "pro", False),
        ("acc_c", None, None, True), ("acc_d", "GB", None, False)]
    now = dims.current_plan(w["int_subscription_history"], as_of=mini.AS_OF)
    assert rows(now, "account_id", "plan_code") == [("acc_a", "pro")]


def test_standardised_prices(w):
    assert rows(w["int_subscription_history"].where("customer_id = 'cus_a'"), "plan_code", "monthly_unit_amount") == [
        ("free", 0.0), ("pro", 20.0), ("pro", 20.0)]
    assert rows(w["stg_billing_prices"], "price_id", "plan_code", "billing_frequency") == [
        ("prc_ent", "enterprise", "monthly"), ("prc_ent_year", "enterprise", "annual"),
        ("prc_free", "free", "monthly"), ("prc_pro", "pro", "monthly")]


def test_mrr_counts_the_end_month_and_no_future_period(w):
    jan, feb, mar = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
    assert rows(w["fct_account_mrr"], "account_id", "mrr_month", "mrr", "expansion_mrr") == [
        ("acc_a", jan, 40.0, 0.0), ("acc_a", feb, 140.0, 100.0), ("acc_a", mar, 100.0, 0.0)]
    strict = facts.fct_account_mrr(w["int_subscription_history"], mini.AS_OF, include_end_month=False)
    assert rows(strict, "mrr_month", "mrr") == [(jan, 40.0), (feb, 100.0), (mar, 100.0)]


def test_clamping_drops_months_after_as_of(w):
    ended = w["int_subscription_history"].where("subscription_id = 'sub_3'").withColumn(
        "ended_at", F.lit("2024-05-20").cast("timestamp_ntz"))
    assert facts.fct_account_mrr(ended, mini.AS_OF).count() == 4
    assert facts.fct_account_mrr(ended, mini.AS_OF, clamp_to_as_of=True).count() == 2


def test_retention_is_censored_at_the_last_active_week(w):
    week = date(2023, 12, 31)
    assert rows(w["fct_retention"], "cohort_week", "week_offset", "cohort_size", "retained_accounts") == [
        (week, 0, 3, 2), (week, 1, 3, 1)]


def test_dau_and_wau(w):
    assert rows(reports.dau_wau(w), "activity_date", "dau", "wau", "stickiness") == [
        (date(2024, 1, 1), 2, 2, 1.0), (date(2024, 1, 2), 1, 2, 0.5), (date(2024, 1, 9), 1, 1, 1.0),
        (date(2024, 1, 10), 1, 2, 0.5), (date(2024, 1, 11), 1, 2, 0.5)]


def test_funnel(w):
    assert [r.accounts for r in reports.onboarding_funnel(w).collect()] == [4, 3, 2, 2, 2, 2]
    in_window = metrics.metric_funnel_in_window(w).orderBy("step_number").collect()
    assert [r.accounts for r in in_window] == [3, 2, 2, 2, 1]


def test_kpis(w):
    assert reports.kpis(w).first().asDict() == {
        "total_accounts": 3, "activated_accounts": 1, "activation_rate": 0.3333, "converted_accounts": 2,
        "paid_conversion_rate": 0.5, "latest_month_mrr": 100.0, "total_events": 15,
        # first week: three features used by both accounts; second week: three features by one of two
        "avg_feature_adoption": 0.75}


def test_paid_base_fills_every_day(w):
    base = w["fct_paid_base_daily"].orderBy("day_date").collect()
    assert (base[0].day_date, base[-1].day_date, len(base)) == (date(2024, 1, 10), date(2024, 6, 1), 144)
    assert [r.paid_accounts for r in base] == [1] * 143 + [2]


def test_churn_needs_a_live_period_of_the_month(w):
    assert rows(w["fct_churn"], "month", "active_at_start", "churned_accounts", "churn_rate") == [
        (date(2024, 2, 1), 1, 0, 0.0), (date(2024, 6, 1), 1, 0, 0.0)]


def test_expansion_reason(w):
    assert rows(metrics.metric_expansion_reason(w), "month", "reason", "changes", "expansion_mrr") == [
        (date(2024, 1, 1), "upgrade", 1, 40.0), (date(2024, 2, 1), "seat_add", 1, 60.0)]


def test_company_versions(spark):
    versions = record_versions(mini.company_loads(spark), "company_id")
    assert rows(versions.where("company_id = 'cmp_d'"), "lifecycle_stage", "valid_to", "is_current") == [
        ("churned", None, True), ("lead", mini.at("2024-02-01"), False)]


def test_all_business_checks_pass(w):
    result = quality.summary(w)
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, quality.run(
        {name: check(w) for name, check in quality.BUSINESS_CHECKS.items()}).collect()))
    assert result.count() == 19
    assert rows(result.where("violations > 0"), "check_name") == []


def test_generic_checks_fire_for_the_account_without_crm(w):
    results = quality.all_generic_results(w, list(MODELS))
    assert results.count() == 81
    assert rows(results.where("violations > 0"), "table_name", "test", "column_name", "violations") == [
        ("dim_accounts", "not_null", "company_id", 1)]
    assert quality.grain_results(w).where("violations > 0").count() == 0


def test_stored_tables_equal_the_composed_plans(w, spark):
    composed = mini.warehouse(spark)
    for name in ("dim_accounts", "fct_user_activation", "fct_retention", "fct_usage_expansion", "fct_product_events"):
        columns = composed[name].columns
        assert w[name].count() == composed[name].count(), name
        assert w[name].select(*columns).exceptAll(composed[name]).count() == 0, name
    assert set(w.build()._frames) >= set(MODELS)
