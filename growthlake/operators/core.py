"""Core models: identity, activity, usage, activation, subscription history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.functions.semantics import WEEKS_PER_WORD, month_start, week_number, week_start, when_in
from growthlake.functions.vocabulary import (
    ACTIVATION_SIGNALS, ACTIVATION_WINDOW_DAYS, ACTIVITY_EVENTS, FEATURE_OF_EVENT, SIGNUP_EVENT,
)


def int_identity_mapping(events: DataFrame, companies: DataFrame, customers: DataFrame) -> DataFrame:
    """Product account -> CRM company and billing customer, with flags for the missing ones."""
    def linked(df: DataFrame, id_column: str) -> DataFrame:
        return df.where(F.col("account_ref").isNotNull()).select(
            F.col("account_ref").alias("account_id"), id_column)

    accounts = events.where(F.col("account_id").isNotNull()).select("account_id").distinct()
    return (
        accounts
        .join(linked(companies, "company_id"), "account_id", "left")
        .join(linked(customers, "customer_id"), "account_id", "left")
        .select(
            "account_id", "company_id", "customer_id",
            F.col("company_id").isNull().alias("crm_identity_missing"),
            F.col("customer_id").isNull().alias("billing_identity_missing"),
        )
    )


def int_user_activity(events: DataFrame) -> DataFrame:
    """User x account x day: number of events and of different activity events.

    The vocabulary is fixed, so the distinct count is the number of bits set:
    one shuffle of pre-aggregated rows instead of the two of a distinct count.
    """
    bit = reduce(
        lambda cases, numbered: cases.when(F.col("event_name") == numbered[1], 1 << numbered[0]),
        enumerate(ACTIVITY_EVENTS), F,
    )
    return (
        events.where(F.col("event_name").isin(ACTIVITY_EVENTS))
        .groupBy(
            F.col("distinct_id").alias("user_id"), "account_id", F.to_date("event_at").alias("activity_date"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.bit_count(F.bit_or(bit)).cast("bigint").alias("distinct_features"),
        )
    )


def int_account_usage(activity: DataFrame) -> DataFrame:
    """Account x month: events, feature touches and days with activity.

    A month has 31 days at most, so the days are bits as well.
    """
    day_bit = F.expr("shiftleft(1L, dayofmonth(activity_date))")
    return activity.groupBy("account_id", month_start("activity_date").alias("usage_month")).agg(
        F.sum("event_count").alias("total_events"),
        F.sum("distinct_features").alias("feature_touches"),
        F.bit_count(F.bit_or(day_bit)).cast("bigint").alias("active_days"),
    )


def int_active_weeks(activity: DataFrame, *also_by: Column) -> DataFrame:
    """Account x era of 64 weeks: a word with a bit per week with activity.

    Words of one account and era may be joined with ``bit_or``. Activity
    without a date counts as a week of its own, in no era.
    """
    number = week_number(week_start("activity_date"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(WEEKS_PER_WORD)))
    return activity.groupBy("account_id", F.floor(number / WEEKS_PER_WORD).alias("era"), *also_by).agg(
        F.bit_or(F.coalesce(bit, F.lit(1).cast("long"))).alias("weeks"))


def feature_code(event_name: Column) -> Column:
    members: dict[str, list[str]] = {}
    for event, feature in FEATURE_OF_EVENT.items():
        members.setdefault(feature, []).append(event)
    return when_in(event_name, members, F.lit(None).cast("string"))


def int_feature_usage(events: DataFrame) -> DataFrame:
    """Account x feature x week: number of events."""
    return (
        events.where(F.col("event_name").isin(list(FEATURE_OF_EVENT)))
        .groupBy(
            "account_id",
            feature_code(F.col("event_name")).alias("feature_code"),
            week_start("event_at").alias("usage_week"),
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def first_signups(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_name") == SIGNUP_EVENT).groupBy("account_id").agg(
        F.min("event_at").alias("signup_at"))


def window_end(signup_at: Column) -> Column:
    return signup_at + F.expr(f"interval {ACTIVATION_WINDOW_DAYS} days")


def int_user_activation(events: DataFrame) -> DataFrame:
    """Account: time of each activation signal and whether all came within the window.

    A signal counts with its last time up to the end of the window, however
    early. Accounts that miss a signal keep a ``time_to_activation_days`` that
    means nothing; reports look at activated accounts only.

    One pass brings the events down to a row per account and hour, which has
    the signup too, so an account with very many events never brings them all
    to one task. Only in the hour in which the window ends do single events
    matter: a second pass looks at those, for accounts that have a signal then.
    """
    wanted = events.where(F.col("event_name").isin([SIGNUP_EVENT, *ACTIVATION_SIGNALS.values()])).select(
        "account_id", "event_name", "event_at", F.date_trunc("hour", "event_at").alias("hour"))
    signals = [F.when(F.col("event_name") == event, F.col("event_at")).alias(c) for c, event in ACTIVATION_SIGNALS.items()]
    last_times = [F.max(c).alias(c) for c in ACTIVATION_SIGNALS]
    signup = F.when(F.col("event_name") == SIGNUP_EVENT, F.col("event_at")).alias("signup_at")
    hours = wanted.select("account_id", "hour", signup, *signals).groupBy("account_id", "hour").agg(
        F.min("signup_at").alias("signup_at"), *last_times)
    # one row per hour at most, so an account's window stays small
    hours = hours.withColumn("signup_at", F.min("signup_at").over(Window.partitionBy("account_id")))
    end = window_end(F.col("signup_at"))
    hours = hours.where(F.col("signup_at").isNotNull()).withColumn("end_hour", F.date_trunc("hour", end))
    # events without an account belong to none, though they may hold a signup
    counts = (F.col("hour") < F.col("end_hour")) & F.col("account_id").isNotNull()
    in_time = hours.select("account_id", "signup_at", *[F.when(counts, F.col(c)).alias(c) for c in ACTIVATION_SIGNALS])
    edges = hours.where(F.col("hour") == F.col("end_hour")).where(
        F.coalesce(*ACTIVATION_SIGNALS).isNotNull()).select(
        F.col("account_id").alias("edge_account"), F.col("hour").alias("edge_hour"), "signup_at")
    # a plain equality would bar null accounts from the first pass, which then would not serve both its uses
    met = F.col("account_id").eqNullSafe(F.col("edge_account")) & (F.col("hour") == F.col("edge_hour"))
    counts = (F.col("event_at") <= end) & F.col("account_id").isNotNull()
    at_the_end = wanted.select("account_id", "hour", "event_at", *signals).join(edges, met).select(
        "account_id", "signup_at", *[F.when(counts, F.col(c)).alias(c) for c in ACTIVATION_SIGNALS])
    accounts = in_time.unionByName(at_the_end).groupBy("account_id").agg(F.min("signup_at").alias("signup_at"), *last_times)
    times = [F.col(c) for c in ACTIVATION_SIGNALS]
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (
        accounts
        .withColumn("activation_at", F.greatest(*[F.coalesce(t, epoch) for t in times]))
        .withColumn("is_activated", reduce(lambda a, b: a & b, [t.isNotNull() for t in times]))
        .withColumn("time_to_activation_days", F.datediff("activation_at", "signup_at"))
    )


def int_subscription_history(subscriptions: DataFrame, prices: DataFrame, customers: DataFrame) -> DataFrame:
    """Subscription period with its price and account; annual prices as a twelfth per month."""
    price = prices.select("price_id", "plan_code", "unit_amount", "billing_frequency")
    owner = customers.select("customer_id", F.col("account_ref").alias("account_id"))
    monthly = F.when(F.col("billing_frequency") == "annual", F.col("unit_amount") / 12).otherwise(
        F.col("unit_amount"))
    return (
        subscriptions.join(price, "price_id", "left").join(owner, "customer_id", "left")
        .select(
            "subscription_id", "customer_id", "account_id", "price_id", "plan_code", "status", "seats",
            "unit_amount", "billing_frequency", monthly.alias("monthly_unit_amount"),
            "start_date", "ended_at", "recorded_at", "effective_at", "source_updated_at",
        )
    )
