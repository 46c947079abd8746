"""Metrics of the dictionary that have no mart of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.functions.semantics import (
    day_spine, engagement_segment, exact_sum, money, month_spine, month_start, ratio, week_start,
)
from growthlake.functions.vocabulary import ACTIVATION_SIGNALS, FUNNEL_LABELS, SIGNUP_EVENT
from growthlake.operators.adjacent import with_neighbour
from growthlake.operators.core import first_signups, window_end
from growthlake.operators.facts import fct_retention, mrr_levels
from growthlake.plans.reports import lifetime_events, onboarding_funnel
from growthlake.plans.warehouse import Warehouse


def _distinct_count(df: DataFrame, by: list, counted: str, name: str) -> DataFrame:
    """Different values per group, duplicates dropped before the shuffle by group."""
    pairs = df.select(*by, counted).distinct()
    return pairs.groupBy(*[c for c in pairs.columns if c != counted]).agg(F.count(counted).alias(name))


def metric_new_users(w: Warehouse) -> DataFrame:
    signups = w["stg_product_events"].where(F.col("event_name") == "user_signup")
    return _distinct_count(signups, [F.to_date("event_at").alias("day")], "distinct_id", "new_users")


def metric_new_users_by_segment(w: Warehouse) -> DataFrame:
    signups = w["stg_product_events"].where(F.col("event_name") == "user_signup")
    by = [F.to_date("event_at").alias("day"), "country", "channel"]
    return _distinct_count(signups, by, "distinct_id", "new_users")


def metric_new_accounts(w: Warehouse) -> DataFrame:
    created = w["stg_product_events"].where(F.col("event_name") == SIGNUP_EVENT)
    return _distinct_count(created, [F.to_date("event_at").alias("day")], "account_id", "new_accounts")


def _step_ratios(steps: DataFrame, within: list[str]) -> DataFrame:
    """Ratios to the first and to the previous step; a funnel has a handful of rows."""
    order = Window.partitionBy(*within).orderBy("step_number")
    accounts = F.col("accounts")
    return steps.withColumns({
        "share_of_first": F.round(ratio(accounts, F.first("accounts").over(order)), 4),
        "share_of_previous": F.round(ratio(accounts, F.lag("accounts").over(order)), 4),
    })


def metric_funnel_conversion(w: Warehouse) -> DataFrame:
    return _step_ratios(onboarding_funnel(w), [])


def metric_funnel_in_window(w: Warehouse) -> DataFrame:
    """Five steps per signup week; a step counts only from signup to the end of the activation window."""
    events = w["stg_product_events"]
    signups = first_signups(events)
    week = week_start("signup_at").alias("signup_week")
    steps = list(ACTIVATION_SIGNALS.values())
    # one row per day of the window, so that the events of a hot account are joined day by day
    days = day_spine(F.to_date("signup_at"), F.to_date(window_end(F.col("signup_at"))))
    reached = (
        events.where(F.col("event_name").isin(steps))
        .select("account_id", "event_name", "event_at", F.to_date("event_at").alias("day"))
        .join(signups.withColumn("day", F.explode(days)), ["account_id", "day"])
        .where((F.col("event_at") >= F.col("signup_at")) & (F.col("event_at") <= window_end(F.col("signup_at"))))
        .groupBy("account_id", week)
        .agg(*[F.bool_or(F.col("event_name") == s).alias(s) for s in steps])
        .groupBy("signup_week")
        .agg(*[F.count_if(s).alias(s) for s in steps])
    )
    cohorts = signups.groupBy(week).agg(F.count(F.lit(1)).alias(SIGNUP_EVENT))
    labels = [label for label in FUNNEL_LABELS if label != "Task created"]
    rows = [
        F.struct(F.lit(i + 1).alias("step_number"), F.lit(label).alias("step"),
                 F.coalesce(event, F.lit(0)).alias("accounts"))
        for i, (label, event) in enumerate(zip(labels, [SIGNUP_EVENT, *steps]))
    ]
    by_step = cohorts.join(reached, "signup_week", "left").select("signup_week", F.inline(F.array(*rows)))
    return _step_ratios(by_step, ["signup_week"])


def metric_retention_by_activation(w: Warehouse) -> DataFrame:
    return fct_retention(w["fct_user_activation"], w["int_active_weeks"], split_by=("is_activated",)).withColumn(
        "retention_rate", F.round("retention_rate", 4))


def metric_churn_by_plan(w: Warehouse) -> DataFrame:
    canceled = w["int_subscription_history"].where(
        (F.col("status") == "canceled") & F.col("ended_at").isNotNull())
    accounts = canceled.groupBy(month_start("ended_at").alias("month"), "plan_code", "account_id").agg(
        F.count(F.lit(1)).alias("n"))
    return accounts.groupBy("month", "plan_code").agg(
        F.count("account_id").alias("churned_accounts"), F.sum("n").alias("canceled_periods"))


def metric_mrr_by_plan(w: Warehouse) -> DataFrame:
    levels = mrr_levels(w["int_subscription_history"], ["plan_code", "account_id"], w.as_of)
    accounts = levels.select(
        "plan_code", "mrr", "account_id", F.explode(month_spine(F.col("first_month"), F.col("last_month"))).alias("mrr_month"))
    return accounts.groupBy("mrr_month", "plan_code").agg(
        money(exact_sum(F.col("mrr"))).alias("mrr"), F.count("account_id").alias("paying_accounts"))


def metric_engagement_segment(w: Warehouse) -> DataFrame:
    return lifetime_events(w).select(
        "account_id", "total_events", engagement_segment(F.col("total_events")).alias("engagement_segment"))


def metric_mrr_by_usage_segment(w: Warehouse) -> DataFrame:
    """Accounts that pay without using the product are in the low segment."""
    segment = engagement_segment(F.coalesce("total_events", F.lit(0))).alias("engagement_segment")
    return w["fct_account_mrr"].join(lifetime_events(w), "account_id", "left").groupBy("mrr_month", segment).agg(
        money(exact_sum(F.col("mrr"))).alias("mrr"),
        money(exact_sum(F.col("expansion_mrr"))).alias("expansion_mrr"),
        F.count("account_id").alias("paying_accounts"),
    )


def metric_expansion_reason(w: Warehouse) -> DataFrame:
    """Rises between consecutive periods of a customer: another price is an upgrade, else seats were added."""
    periods = w["int_subscription_history"].select(
        "customer_id", "subscription_id", "effective_at", "price_id", "seats",
        (F.col("seats") * F.col("monthly_unit_amount")).alias("amount"),
    )
    changed = with_neighbour(
        periods, ["customer_id"], F.date_trunc("hour", "effective_at"), ["effective_at", "subscription_id"],
        ["price_id", "amount"], name="before")
    rise = F.col("amount") - F.col("before.amount")
    reason = F.when(F.col("price_id") != F.col("before.price_id"), "upgrade").otherwise("seat_add")
    return (
        changed.where(rise > 0)
        .groupBy(month_start("effective_at").alias("month"), reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("changes"), money(exact_sum(rise)).alias("expansion_mrr"))
    )


def metric_dau_by_country(w: Warehouse) -> DataFrame:
    country = w["dim_accounts"].select("account_id", "country")
    active = w["fct_user_daily_activity"].select("account_id", "user_id", "activity_date").join(country, "account_id")
    return _distinct_count(active, ["activity_date", "country"], "user_id", "dau")


def metric_adoption_by_size(w: Warehouse) -> DataFrame:
    """Feature x week x company size: accounts that used the feature, of those active."""
    size = w["dim_accounts"].select("account_id", "company_size")
    using = (
        w["int_feature_usage"].join(size, "account_id")
        .groupBy("feature_code", F.col("usage_week").alias("week"), "company_size")
        .agg(F.count_distinct("account_id").alias("accounts_using_feature"))
    )
    active = _distinct_count(
        w["int_user_activity"].select("account_id", week_start("activity_date").alias("week")).distinct()
        .join(size, "account_id"),
        ["week", "company_size"], "account_id", "active_accounts",
    ).withColumnsRenamed({"week": "active_week", "company_size": "active_size"})
    same = (F.col("week") == F.col("active_week")) & F.col("company_size").eqNullSafe(F.col("active_size"))
    return using.join(active, same, "left").select(
        "feature_code", "week", "company_size", "accounts_using_feature",
        F.coalesce("active_accounts", F.lit(0)).alias("active_accounts"),
        F.round(ratio(F.col("accounts_using_feature"), F.col("active_accounts")), 4).alias("adoption_rate"),
    )


def metric_churn_true(w: Warehouse) -> DataFrame:
    """Churn as the dictionary means it, by the time periods cover.

    Active: a period covers the first day of the month. Churned: of those, a
    canceled period ended in the month and none covers the first day of the next.
    Months up to ``as_of``.
    """
    last = F.trunc(F.lit(w.as_of).cast("date"), "MM")
    after_last = F.add_months(last, 1)
    start, end = F.to_date("effective_at"), F.to_date("ended_at")
    # first day of a month on or after the start, and the last one before the end
    first_covered = F.when(start == month_start(start), start).otherwise(F.add_months(month_start(start), 1))
    last_covered = F.least(after_last, F.trunc(F.date_sub(end, 1), "MM"))
    covered = F.when(
        last_covered >= first_covered, F.sequence(first_covered, last_covered, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))

    def mark(month: Column, what: str) -> Column:
        return F.struct(month.alias("month"), F.lit(what).alias("what"))

    facts = F.concat(
        F.transform(covered, lambda m: mark(m, "live")),
        F.transform(covered, lambda m: mark(F.add_months(m, -1), "live_next")),
        F.array_compact(F.array(F.when(
            (F.col("status") == "canceled") & end.isNotNull(), mark(month_start(end), "canceled")))),
    )

    def has(what: str) -> Column:
        return F.bool_or(F.col("what") == what).alias(what)

    lost = F.col("canceled") & ~F.col("live_next")
    return (
        w["int_subscription_history"].where(F.col("account_id").isNotNull())
        .select("account_id", F.inline(facts))
        .where(F.col("month") <= last)
        .groupBy("account_id", "month").agg(has("live"), has("live_next"), has("canceled"))
        .where("live")
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("active_at_start"), F.count_if(lost).alias("churned_accounts"))
        .withColumn("churn_rate", F.round(ratio(F.col("churned_accounts"), F.col("active_at_start")), 4))
    )


def late_events(w: Warehouse) -> DataFrame:
    """Events that arrived more than an hour late, on the day they happened."""
    late = F.col("event_at") < F.col("source_updated_at") - F.expr("interval 1 hour")
    return w["stg_product_events"].groupBy(F.to_date("event_at").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(late).alias("late_events"))


METRICS = {f.__name__: f for f in (
    metric_new_users, metric_new_users_by_segment, metric_new_accounts, metric_funnel_conversion,
    metric_funnel_in_window, metric_retention_by_activation, metric_churn_by_plan, metric_mrr_by_plan,
    metric_mrr_by_usage_segment, metric_expansion_reason, metric_engagement_segment, metric_dau_by_country,
    metric_adoption_by_size, metric_churn_true, late_events,
)}
