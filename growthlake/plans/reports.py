"""Report queries over the marts, and the small queries report pages put on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.functions.semantics import engagement_segment, exact_sum, money, ratio, share
from growthlake.functions.vocabulary import FUNNEL_LABELS, JOURNEY_STEPS
from growthlake.plans.warehouse import Warehouse


def _rows() -> Column:
    return F.count(F.lit(1))


def slice_by(
    fact: DataFrame, accounts: DataFrame, by: dict[str, str], flag: str, hits: str, rate: str
) -> DataFrame:
    """Share of a fact's accounts with the flag, by attributes of the account (attribute -> output name)."""
    attributes = accounts.select("account_id", *[F.col(c).alias(name) for c, name in by.items()])
    return fact.select("account_id", flag).join(attributes, "account_id").groupBy(*by.values()).agg(
        _rows().alias("accounts"),
        F.count_if(F.col(flag)).alias(hits),
        share(F.col(flag)).alias(rate),
    )


def _activation_by(w: Warehouse, by: dict[str, str]) -> DataFrame:
    return slice_by(w["fct_user_activation"], w["dim_accounts"], by,
                    "is_activated", "activated", "activation_rate").orderBy(*by.values())


def _conversion_by(w: Warehouse, by: dict[str, str]) -> DataFrame:
    return slice_by(w["fct_paid_conversion"], w["dim_accounts"], by,
                    "is_converted", "converted", "conversion_rate").orderBy(*by.values())


def lifetime_events(w: Warehouse) -> DataFrame:
    """Rows of fct_product_events per account, counted before the identity is joined instead of after."""
    counted = w["stg_product_events"].groupBy("account_id").agg(_rows().alias("n"))
    return counted.join(w["int_identity_mapping"].select("account_id"), "account_id", "left").groupBy(
        "account_id").agg(F.sum("n").alias("total_events"))


def kpis(w: Warehouse) -> DataFrame:
    """One row; each mart is read once."""
    activation = w["fct_user_activation"].agg(
        F.count("account_id").alias("total_accounts"),
        F.count_if("is_activated").alias("activated_accounts"),
        share(F.col("is_activated")).alias("activation_rate"),
    )
    conversion = w["fct_paid_conversion"].agg(F.struct(
        F.count_if("is_converted").alias("accounts"), share(F.col("is_converted")).alias("rate"))).scalar()
    # the newest month is the largest (month, sum) pair: no second read to find it
    revenue = w["fct_account_mrr"].groupBy("mrr_month").agg(exact_sum(F.col("mrr")).alias("mrr")).agg(
        F.max_by("mrr", "mrr_month")).scalar()
    events = lifetime_events(w).agg(F.sum("total_events")).scalar()
    adoption = w["fct_feature_adoption"].agg(F.avg("adoption_rate")).scalar()
    return activation.select(
        "*",
        conversion["accounts"].alias("converted_accounts"),
        conversion["rate"].alias("paid_conversion_rate"),
        money(revenue).alias("latest_month_mrr"),
        events.alias("total_events"),
        F.round(adoption, 4).alias("avg_feature_adoption"),
    )


def activation_rate(w: Warehouse) -> DataFrame:
    return w["fct_user_activation"].groupBy(F.col("signup_week").alias("cohort")).agg(
        _rows().alias("accounts"),
        F.count_if("is_activated").alias("activated"),
        share(F.col("is_activated")).alias("activation_rate"),
    ).orderBy("cohort")


def activation_by_country(w: Warehouse) -> DataFrame:
    return _activation_by(w, {"country": "country"})


def activation_by_industry(w: Warehouse) -> DataFrame:
    return _activation_by(w, {"industry": "industry"})


def activation_by_plan(w: Warehouse) -> DataFrame:
    return _activation_by(w, {"plan_code": "plan"})


def activation_by_size(w: Warehouse) -> DataFrame:
    return _activation_by(w, {"company_size": "company_size"})


def activation_by_country_plan(w: Warehouse) -> DataFrame:
    return _activation_by(w, {"country": "country", "plan_code": "plan_code"})


def conversion_by_country(w: Warehouse) -> DataFrame:
    return _conversion_by(w, {"country": "country"})


def conversion_by_industry(w: Warehouse) -> DataFrame:
    return _conversion_by(w, {"industry": "industry"})


def time_to_activation(w: Warehouse) -> DataFrame:
    """Exact percentiles: the days are few different integers, so the buffers stay small."""
    days = F.col("time_to_activation_days")

    def percentile(p: float) -> Column:
        return F.round(F.percentile(days, F.lit(p)), 2)

    return w["fct_user_activation"].where("is_activated").agg(
        percentile(0.25).alias("p25_days"),
        percentile(0.5).alias("p50_days"),
        percentile(0.9).alias("p90_days"),
        F.round(F.avg(days), 2).alias("avg_days"),
        _rows().alias("activated_accounts"),
    )


def time_to_activation_distribution(w: Warehouse) -> DataFrame:
    return w["fct_user_activation"].where("is_activated").groupBy("time_to_activation_days").agg(
        _rows().alias("accounts")).orderBy("time_to_activation_days")


def activation_vs_activity(w: Warehouse) -> DataFrame:
    weeks = w["int_active_weeks"].groupBy("account_id").agg(F.sum(F.bit_count("weeks")).alias("active_weeks"))
    return w["fct_user_activation"].select("account_id", "is_activated").join(weeks, "account_id", "left").select(
        "account_id", "is_activated", F.coalesce("active_weeks", F.lit(0)).alias("active_weeks"))


def avg_active_weeks_by_activation(w: Warehouse) -> DataFrame:
    return activation_vs_activity(w).groupBy("is_activated").agg(
        F.round(F.avg("active_weeks"), 4).alias("avg_active_weeks"))


def onboarding_funnel(w: Warehouse) -> DataFrame:
    """All steps from one aggregate, then turned into rows."""
    counts = w["fct_user_journey"].agg(
        _rows().alias("c0"),
        *[F.count_if(f"reached_{step}").alias(f"c{i}") for i, step in enumerate(JOURNEY_STEPS, 1)],
    )
    steps = [
        F.struct(F.lit(i + 1).alias("step_number"), F.lit(label).alias("step"), F.col(f"c{i}").alias("accounts"))
        for i, label in enumerate(FUNNEL_LABELS)
    ]
    return counts.select(F.inline(F.array(*steps))).orderBy("step_number")


def funnel_table(w: Warehouse) -> DataFrame:
    return onboarding_funnel(w).select("step", "accounts")


def funnel_percent(w: Warehouse) -> DataFrame:
    """Each step as a share of the first. The window sees six rows."""
    first = F.first("accounts").over(Window.orderBy("step_number"))
    return onboarding_funnel(w).select(
        "step_number", "step", "accounts", F.round(ratio(F.col("accounts"), first), 4).alias("share_of_first"))


def dau_wau(w: Warehouse) -> DataFrame:
    """Users per day, users per trailing seven days, and their ratio.

    A user's active day covers the seven days from it, up to the user's next
    active day. The covers of a user never overlap, so the weekly audience of a
    day is the number of covers open on it: starts minus ends, added up. This
    needs two small rows per user-day, and no distinct count over seven copies.
    """
    user_days = w["fct_user_daily_activity"].select("user_id", "activity_date").distinct()
    # a user has one row per calendar day at most
    following = F.lead("activity_date").over(Window.partitionBy("user_id").orderBy("activity_date"))
    cover_end = F.least(F.date_add("activity_date", 7), following)
    changes = (
        user_days.select("activity_date", cover_end.alias("cover_end"))
        .select(F.inline(F.array(
            F.struct(F.col("activity_date").alias("day"), F.lit(1).alias("active"), F.lit(1).alias("change")),
            F.struct(F.col("cover_end").alias("day"), F.lit(0).alias("active"), F.lit(-1).alias("change")),
        )))
        .groupBy("day").agg(F.sum("active").alias("dau"), F.sum("change").alias("change"))
    )
    # one row per calendar day
    running = F.sum("change").over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    return (
        changes.withColumn("wau", running).where(F.col("dau") > 0)
        .select(
            F.col("day").alias("activity_date"), "dau", "wau",
            F.round(ratio(F.col("dau"), F.col("wau")), 4).alias("stickiness"),
        )
        .orderBy("activity_date")
    )


def avg_dau_stickiness(w: Warehouse) -> DataFrame:
    return dau_wau(w).agg(
        F.round(F.avg("dau"), 4).alias("avg_dau"), F.round(F.avg("stickiness"), 4).alias("avg_stickiness"))


def feature_adoption(w: Warehouse) -> DataFrame:
    return w["fct_feature_adoption"].groupBy("feature_code").agg(
        F.round(F.avg("adoption_rate"), 4).alias("avg_adoption_rate"),
        F.sum("accounts_using_feature").alias("accounts_using_feature"),
    ).orderBy(F.desc("avg_adoption_rate"))


def feature_adoption_trend(w: Warehouse) -> DataFrame:
    return w["fct_feature_adoption"].select("week", "feature_code", "adoption_rate").orderBy("week", "feature_code")


def paid_conversion(w: Warehouse) -> DataFrame:
    """By activation; an account that never signed up counts as not activated."""
    activated = w["fct_user_activation"].select("account_id", "is_activated")
    return (
        w["fct_paid_conversion"].join(activated, "account_id", "left")
        .withColumn("is_activated", F.coalesce("is_activated", F.lit(False)))
        .groupBy("is_activated")
        .agg(
            _rows().alias("accounts"), F.count_if("is_converted").alias("converted"),
            share(F.col("is_converted")).alias("conversion_rate"),
        )
        .orderBy("is_activated")
    )


def conversion_by_engagement(w: Warehouse) -> DataFrame:
    segment = engagement_segment(F.coalesce("total_events", F.lit(0)))
    return (
        w["fct_paid_conversion"].join(lifetime_events(w), "account_id", "left")
        .groupBy(segment.alias("engagement_segment"))
        .agg(
            _rows().alias("accounts"), F.count_if("is_converted").alias("converted"),
            share(F.col("is_converted")).alias("conversion_rate"),
        )
        .orderBy("engagement_segment")
    )


def retention_cohort(w: Warehouse) -> DataFrame:
    return w["fct_retention"].withColumn("retention_rate", F.round("retention_rate", 4)).orderBy(
        "cohort_week", "week_offset")


def recent_cohorts(w: Warehouse) -> DataFrame:
    """The last six cohorts."""
    rows = retention_cohort(w)
    newest = rows.agg(F.max("cohort_week")).scalar()
    return rows.where(F.col("cohort_week") >= F.date_sub(newest, 35))


def recent_cohort_retention(w: Warehouse) -> DataFrame:
    return recent_cohorts(w).groupBy("cohort_week", "week_offset").agg(
        F.round(F.avg("retention_rate"), 4).alias("avg_retention_rate")).orderBy("cohort_week", "week_offset")


def churn_overview(w: Warehouse) -> DataFrame:
    return w["fct_churn"].withColumn("churn_rate", F.round("churn_rate", 4)).orderBy("month")


def churn_by_usage(w: Warehouse) -> DataFrame:
    """Mean lifetime usage of accounts with and without a canceled period (an upgrade cancels one too)."""
    churned = (
        w["fct_subscription_history"].where(F.col("status") == "canceled").select("account_id").distinct()
        .withColumn("churned", F.lit(True))
    )
    usage = w["fct_usage_expansion"].groupBy("account_id").agg(
        F.sum("total_events").alias("total_events"), F.sum("active_days").alias("active_days"))
    segment = F.when(F.col("churned"), "churned").otherwise("retained")
    return usage.join(churned, "account_id", "left").groupBy(segment.alias("segment")).agg(
        F.count("account_id").alias("accounts"),
        F.round(F.avg("total_events"), 1).alias("avg_events"),
        F.round(F.avg("active_days"), 1).alias("avg_active_days"),
    )


def mrr_overview(w: Warehouse) -> DataFrame:
    return w["fct_account_mrr"].groupBy("mrr_month").agg(
        money(exact_sum(F.col("mrr"))).alias("total_mrr"),
        F.count("account_id").alias("paying_accounts"),
        money(exact_sum(F.col("expansion_mrr"))).alias("expansion_mrr"),
    ).orderBy("mrr_month")


def peak_mrr(w: Warehouse) -> DataFrame:
    return mrr_overview(w).agg(F.max("total_mrr").alias("peak_mrr"))


def _latest_mrr_by(w: Warehouse, attribute: str) -> DataFrame:
    mrr = w["fct_account_mrr"]
    latest = mrr.where(F.col("mrr_month") == mrr.agg(F.max("mrr_month")).scalar())
    return latest.join(w["dim_accounts"].select("account_id", attribute), "account_id").groupBy(attribute).agg(
        money(exact_sum(F.col("mrr"))).alias("mrr"),
        F.count_distinct("account_id").alias("paying_accounts"),
    ).orderBy(F.desc("mrr"))


def mrr_by_country(w: Warehouse) -> DataFrame:
    return _latest_mrr_by(w, "country")


def mrr_by_size(w: Warehouse) -> DataFrame:
    return _latest_mrr_by(w, "company_size")


def _rounded_money() -> list[Column]:
    return [money(F.col(c)).alias(c) for c in ("mrr", "expansion_mrr")]


def expansion_accounts(w: Warehouse) -> DataFrame:
    return w["fct_usage_expansion"].where("is_expanding").select(
        "account_id", "month", *_rounded_money(), "total_events", "active_days",
    ).orderBy(F.desc("month"), F.desc("expansion_mrr"))


def usage_vs_mrr(w: Warehouse) -> DataFrame:
    return w["fct_usage_expansion"].select(
        "account_id", "month", "total_events", "active_days", *_rounded_money(), "is_expanding",
    ).orderBy("month", "account_id")


def paid_base(w: Warehouse) -> DataFrame:
    return w["fct_paid_base_daily"].orderBy("day_date")


REPORTS = {f.__name__: f for f in (
    kpis, activation_rate, activation_by_country, activation_by_industry, activation_by_plan,
    activation_by_size, activation_by_country_plan, time_to_activation, time_to_activation_distribution,
    activation_vs_activity, onboarding_funnel, dau_wau, feature_adoption, feature_adoption_trend,
    paid_conversion, conversion_by_country, conversion_by_industry, conversion_by_engagement,
    retention_cohort, churn_overview, churn_by_usage, mrr_overview, mrr_by_country, mrr_by_size,
    expansion_accounts, usage_vs_mrr, paid_base,
    recent_cohorts, recent_cohort_retention, avg_active_weeks_by_activation, avg_dau_stickiness,
    peak_mrr, funnel_table, funnel_percent,
)}
