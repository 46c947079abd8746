"""Data-quality checks. A check is a DataFrame of violating rows; no rows means passed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.functions.semantics import ratio
from growthlake.functions.vocabulary import CANONICAL_COUNTRIES, CANONICAL_PLANS

Tables = Mapping[str, DataFrame] | Any


# generic checks

def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once; rows with a null key are left to ``not_null``."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def outside(column: str, minimum=None, maximum=None) -> Column:
    found = F.lit(False)
    if minimum is not None:
        found = found | (F.col(column) < minimum)
    if maximum is not None:
        found = found | (F.col(column) > maximum)
    return found


def accepted_range(df: DataFrame, column: str, minimum=None, maximum=None) -> DataFrame:
    return df.where(outside(column, minimum, maximum))


# fixed values: key column per table that must be unique
UNIQUE = {
    "stg_product_events": "event_id",
    "stg_crm_contacts": "contact_id",
    "stg_crm_companies": "company_id",
    "stg_crm_deals": "deal_id",
    "stg_billing_customers": "customer_id",
    "stg_billing_prices": "price_id",
    "stg_billing_invoices": "invoice_id",
    "int_identity_mapping": "account_id",
    "int_user_activation": "account_id",
    "dim_accounts": "account_id",
    "dim_plans": "price_id",
    "dim_features": "feature_code",
    "dim_dates": "day_date",
    "fct_product_events": "event_id",
    "fct_user_activation": "account_id",
    "fct_user_journey": "account_id",
    "fct_paid_conversion": "account_id",
    "fct_paid_base_daily": "day_date",
}

# fixed values: columns per table that must not be null
NOT_NULL = {
    "stg_product_events": ["event_id", "event_name", "distinct_id", "account_id", "event_at"],
    "stg_crm_contacts": ["contact_id", "email"],
    "stg_crm_companies": ["company_id", "country"],
    "stg_crm_deals": ["deal_id", "company_id"],
    "stg_billing_customers": ["customer_id"],
    "stg_billing_prices": ["price_id", "plan_code"],
    "stg_billing_subscriptions": ["subscription_id", "customer_id"],
    "stg_billing_invoices": ["invoice_id"],
    "int_identity_mapping": ["account_id"],
    "int_user_activity": ["user_id", "activity_date"],
    "int_user_activation": ["account_id", "is_activated"],
    "int_feature_usage": ["account_id", "feature_code"],
    "int_subscription_history": ["subscription_id", "customer_id"],
    "int_account_usage": ["account_id", "usage_month"],
    "dim_accounts": ["account_id", "company_id", "customer_id"],
    "dim_plans": ["price_id", "plan_code"],
    "dim_features": ["feature_code"],
    "dim_dates": ["day_date"],
    "fct_product_events": ["event_id", "account_id", "event_at"],
    "fct_user_activation": ["account_id", "is_activated"],
    "fct_user_daily_activity": ["user_id", "activity_date"],
    "fct_feature_adoption": ["feature_code", "week", "adoption_rate"],
    "fct_user_journey": ["account_id"],
    "fct_subscription_history": ["subscription_id", "effective_at"],
    "fct_account_mrr": ["account_id", "mrr_month", "mrr"],
    "fct_paid_conversion": ["account_id"],
    "fct_retention": ["cohort_week", "week_offset", "retention_rate"],
    "fct_churn": ["month", "churn_rate"],
    "fct_usage_expansion": ["account_id", "month"],
    "fct_paid_base_daily": ["day_date", "cum_converted", "cum_churned", "paid_accounts"],
}

# grains of more than one column, which a single-column test cannot state
GRAINS = {
    "int_user_activity": ["user_id", "account_id", "activity_date"],
    "int_account_usage": ["account_id", "usage_month"],
    "int_feature_usage": ["account_id", "feature_code", "usage_week"],
    "fct_feature_adoption": ["feature_code", "week"],
    "fct_account_mrr": ["account_id", "mrr_month"],
    "fct_retention": ["cohort_week", "week_offset"],
    "fct_churn": ["month"],
    "fct_usage_expansion": ["account_id", "month"],
}


def _result(test: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(test).alias("test"), F.lit(column).alias("column_name"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"))


def row_metrics(table: str, as_of: str) -> dict[str, Column]:
    """All checks of a table that look at single rows, as aggregates to take while it is written."""
    checks = {f"null {c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL.get(table, [])}
    checks |= {name: F.count_if(condition(as_of)) for name, (of, condition) in BROKEN_ROWS.items() if of == table}
    return checks | {name: F.count_if(found()) for name, (of, found) in MUST_OCCUR.items() if of == table}


def _measured(tables: Tables, name: str) -> Mapping[str, int] | None:
    """What was counted when the table was written, if it was."""
    return getattr(tables, "measured", {}).get(name)


def generic_results(df: DataFrame, table: str, measured: Mapping[str, int] | None = None) -> DataFrame:
    """All generic tests of a table: (table, test, column, violations).

    Null counts that were measured when the table was written are taken from
    there; then the unique test reads the key column and nothing else is read.
    Otherwise one scan serves all: rows are counted per key (partial sums before
    the shuffle), and the null counts ride along.
    """
    columns = NOT_NULL[table]
    key = UNIQUE.get(table)
    if measured is not None:
        results = [_result("not_null", c, F.lit(measured[f"null {c}"])) for c in columns]
        if key is not None:
            repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).agg(
                F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_repeated"))
            results.insert(0, _result("unique", key, F.col("_repeated")))
        else:
            repeated = df.sparkSession.range(1)
        return repeated.select(F.lit(table).alias("table_name"), F.inline(F.array(*results)))
    nulls = {c: f"_null_{c}" for c in columns}
    results = [_result("not_null", c, F.col(n)) for c, n in nulls.items()]
    if key is None:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()])
    else:
        counts = (
            df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items() if c != key])
            .agg(F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_repeated"),
                 *[F.sum(F.when(F.col(key).isNull(), F.col("_n"))).alias(n) if c == key else F.sum(n).alias(n)
                   for c, n in nulls.items()])
        )
        results.insert(0, _result("unique", key, F.col("_repeated")))
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*results)))


def all_generic_results(tables: Tables, names: list[str]) -> DataFrame:
    frames = {n: tables[n] for n in names}
    return reduce(DataFrame.unionByName, [generic_results(df, n, _measured(tables, n)) for n, df in frames.items()])


def grain_results(tables: Tables) -> DataFrame:
    """Repeated keys per composite grain."""
    return run({name: unique(tables[name], *keys) for name, keys in GRAINS.items()})


# business checks

def _skipped(later: str, earlier: str) -> Column:
    return F.col(f"reached_{later}") & ~F.col(f"reached_{earlier}")


def _plan_missing() -> Column:
    return F.col("plan_code").isNull() | ~F.col("plan_code").isin(CANONICAL_PLANS)


# rows of a table that break a rule: table, and the condition given today's date
BROKEN_ROWS: dict[str, tuple[str, Callable[[str], Column]]] = {
    "dq_activation_after_signup": (
        "fct_user_activation", lambda _: F.col("is_activated") & (F.col("activation_at") < F.col("signup_at"))),
    "dq_activation_within_window": (
        "fct_user_activation", lambda _: F.col("is_activated") & (F.col("time_to_activation_days") > 7)),
    "dq_churn_rate_bounded": ("fct_churn", lambda _: outside("churn_rate", 0, 1)),
    "dq_country_standardised": ("stg_crm_companies", lambda _: ~F.col("country").isin(CANONICAL_COUNTRIES)),
    "dq_expansion_non_negative": ("fct_account_mrr", lambda _: outside("expansion_mrr", minimum=0)),
    "dq_adoption_rate_bounded": ("fct_feature_adoption", lambda _: outside("adoption_rate", 0, 1)),
    "dq_future_effective": (
        "fct_account_mrr", lambda as_of: F.col("mrr_month") > F.trunc(F.lit(as_of).cast("date"), "MM")),
    "dq_journey_monotonic": (
        "fct_user_journey", lambda _: _skipped("project", "workspace") | _skipped("task_created", "project")
        | _skipped("task_completed", "task_created")),
    "dq_mrr_non_negative": ("fct_account_mrr", lambda _: outside("mrr", minimum=0)),
    "dq_plan_code_populated": ("stg_billing_prices", lambda _: _plan_missing()),
    "dq_retention_rate_bounded": ("fct_retention", lambda _: outside("retention_rate", 0, 1)),
    "dq_subscription_dates": ("fct_subscription_history", lambda _: F.col("ended_at") < F.col("start_date")),
}
# scenarios that a table must show: one violation if no row does
MUST_OCCUR: dict[str, tuple[str, Callable[[], Column]]] = {
    "dq_late_crm_applied": ("stg_crm_companies", lambda: F.col("lifecycle_stage").isin("customer", "churned")),
    "dq_late_events_backfilled": (
        "fct_product_events", lambda: F.col("event_at") < F.col("source_updated_at") - F.expr("interval 1 hour")),
    "dq_lifecycle_transition": ("stg_crm_companies", lambda: F.col("lifecycle_stage") == "churned"),
    "dq_history_append_only": ("fct_subscription_history", lambda: F.col("status") == "superseded"),
}


def activation_rate_bounded(t: Tables) -> DataFrame:
    weeks = t["fct_user_activation"].groupBy("signup_week").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_activated").alias("activated"))
    rate = ratio(F.col("activated"), F.col("total"))
    return weeks.where((rate < 0) | (rate > 1))


def missing_association(t: Tables) -> DataFrame:
    counts = t["stg_crm_contacts"].agg(F.count("company_id").alias("linked"), F.count(F.lit(1)).alias("total"))
    return counts.where((F.col("linked") == 0) | (ratio(F.col("linked"), F.col("total")) < 0.5))


def no_duplicate_events(t: Tables) -> DataFrame:
    return unique(t["fct_product_events"], "event_id")


# checks that need the rows of a group or table together
GROUPED: dict[str, Callable[[Tables], DataFrame]] = {
    f"dq_{f.__name__}": f for f in (activation_rate_bounded, missing_association, no_duplicate_events)}


def _row_check(table: str, condition: Callable[[str], Column]) -> Callable[[Tables], DataFrame]:
    return lambda t: t[table].where(condition(t.as_of))


def _scenario_check(table: str, found: Callable[[], Column]) -> Callable[[Tables], DataFrame]:
    return lambda t: t[table].agg(F.count_if(found()).alias("n")).where(F.col("n") == 0)


BUSINESS_CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    **{name: _row_check(*check) for name, check in BROKEN_ROWS.items()},
    **{name: _scenario_check(*check) for name, check in MUST_OCCUR.items()},
    **GROUPED,
}


def run(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Violations per check."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def violations_measured(tables: Tables, table: str) -> dict[str, int]:
    """Violations per row or scenario check of a table, as counted when it was written."""
    counted = _measured(tables, table) or {}
    broken = {n: counted[n] for n, (of, _) in BROKEN_ROWS.items() if of == table and n in counted}
    return broken | {n: int(counted[n] == 0) for n, (of, _) in MUST_OCCUR.items() if of == table and n in counted}


def summary(t: Tables) -> DataFrame:
    """Violations per business check.

    Row and scenario checks come from what was measured when their tables were
    written, without reading them; else from one scan per table.
    """
    counts: dict[str, dict[str, Column]] = {}
    for name, (table, condition) in BROKEN_ROWS.items():
        counts.setdefault(table, {})[name] = F.count_if(condition(t.as_of))
    for name, (table, found) in MUST_OCCUR.items():
        counts.setdefault(table, {})[name] = (F.count_if(found()) == 0).cast("bigint")
    frames = {table: t[table] for table in counts}
    known = {name: n for table in counts for name, n in violations_measured(t, table).items()}
    fused = [
        frames[table].agg(F.array(*(
            F.struct(F.lit(name).alias("check_name"), n.alias("violations")) for name, n in of.items())).alias("results"))
        .select(F.inline("results")) for table, of in counts.items() if not of.keys() <= known.keys()
    ]
    if known:
        spark = next(iter(frames.values())).sparkSession
        fused.append(spark.createDataFrame(sorted(known.items()), "check_name string, violations bigint"))
    return reduce(DataFrame.unionByName, [*fused, run({name: check(t) for name, check in GROUPED.items()})])
