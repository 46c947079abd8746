"""Each business check finds the row that breaks its rule, among good ones."""

import mini
import pytest
from pyspark.sql import functions as F

from growthlake.operators import quality


class Damaged:
    """The mini warehouse with some tables replaced."""

    def __init__(self, tables, **changed):
        self.tables, self.changed, self.as_of = tables, changed, tables.as_of

    def __getitem__(self, name):
        return self.changed.get(name, self.tables[name])


@pytest.fixture(scope="module")
def built(spark):
    return mini.warehouse(spark)


def bent(table, where="true", **columns):
    """The table with columns set by SQL where the condition holds."""
    def damage(w):
        df = w[table]
        return {table: df.withColumns({
            c: F.expr(f"CASE WHEN {where} THEN {x} ELSE {c} END").cast(df.schema[c].dataType) for c, x in columns.items()})}
    return damage


DAMAGE = {
    "dq_activation_after_signup": bent("fct_user_activation", is_activated="true", activation_at="signup_at - interval 1 hour"),
    "dq_activation_rate_bounded": lambda w: {"fct_user_activation": w["fct_user_activation"]},
    "dq_activation_within_window": bent("fct_user_activation", is_activated="true", time_to_activation_days="8"),
    "dq_churn_rate_bounded": bent("fct_churn", churn_rate="1.5"),
    "dq_country_standardised": bent("stg_crm_companies", country="'USA'"),
    "dq_expansion_non_negative": bent("fct_account_mrr", expansion_mrr="-1"),
    "dq_adoption_rate_bounded": bent("fct_feature_adoption", adoption_rate="1.01"),
    "dq_future_effective": bent("fct_account_mrr", mrr_month="date'2030-01-01'"),
    "dq_journey_monotonic": bent("fct_user_journey", reached_workspace="false", reached_project="true"),
    "dq_late_crm_applied": bent("stg_crm_companies", lifecycle_stage="'lead'"),
    "dq_late_events_backfilled": bent("fct_product_events", source_updated_at="event_at"),
    "dq_lifecycle_transition": bent("stg_crm_companies", lifecycle_stage="'customer'"),
    "dq_missing_association": bent("stg_crm_contacts", company_id="null"),
    "dq_mrr_non_negative": bent("fct_account_mrr", mrr="-0.01"),
    "dq_no_duplicate_events": lambda w: {"fct_product_events": w["fct_product_events"].union(w["fct_product_events"].limit(1))},
    "dq_plan_code_populated": bent("stg_billing_prices", plan_code="'legacy'"),
    "dq_retention_rate_bounded": bent("fct_retention", retention_rate="-0.1"),
    "dq_subscription_dates": bent("fct_subscription_history", ended_at="start_date - interval 1 day"),
    "dq_history_append_only": bent("fct_subscription_history", status="'active'"),
}


def test_every_check_has_its_damage():
    assert set(DAMAGE) == set(quality.BUSINESS_CHECKS)


@pytest.mark.parametrize("name", sorted(set(DAMAGE) - {"dq_activation_rate_bounded"}))
def test_check_fires(built, name):
    check = quality.BUSINESS_CHECKS[name]
    assert check(Damaged(built, **DAMAGE[name](built))).count() > 0


def test_activation_rate_is_bounded_by_its_own_counts(built):
    """A share of rows of the same group can't leave 0..1; the check guards the ratio, which must stay so."""
    assert quality.BUSINESS_CHECKS["dq_activation_rate_bounded"](built).count() == 0
