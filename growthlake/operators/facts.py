"""Facts. Each docstring starts with the grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.functions.semantics import (
    WEEKS_PER_WORD, day_spine, last_week_number, month_spine, month_start, ratio, week_number, week_start,
)
from growthlake.functions.vocabulary import JOURNEY_STEPS, LIVE_STATUSES, PAID_PLANS, SIGNUP_EVENT

LAST_RETENTION_WEEK = 12
HEAVY_SHARE = 0.001  # of all events: an account with more is split
SPLITS = 32


def heavy_accounts(events: DataFrame, share: float = HEAVY_SHARE) -> DataFrame:
    """Accounts with at least this share of all events: 1 / share of them at most, whatever the data."""
    counts = events.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.count(F.lit(1)) * F.lit(share)).scalar()
    return counts.where(F.col("n") >= total).select("account_id")


def fct_product_events(events: DataFrame, identity: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Event, with the CRM and billing ids of its account.

    The events of a heavy account are dealt to ``SPLITS`` tasks, each with a
    copy of the account's ids: no task gets a hot account, however Spark is set
    up. ``heavy`` may come from a table that is cheaper to count, as the raw
    deliveries; it changes how rows are dealt, never which.
    """
    few = F.broadcast((heavy_accounts(events) if heavy is None else heavy).select(
        F.col("account_id").alias("heavy_id")))  # bounded: see heavy_accounts
    part = F.pmod(F.xxhash64("event_id"), F.lit(SPLITS)).cast("int")
    dealt = events.join(few, F.col("account_id") == F.col("heavy_id"), "left").withColumn(
        "_part", F.when(F.col("heavy_id").isNotNull(), part).otherwise(F.lit(0)))
    copies = identity.select("account_id", "company_id", "customer_id").join(
        few, F.col("account_id") == F.col("heavy_id"), "left")
    last = F.when(F.col("heavy_id").isNotNull(), SPLITS - 1).otherwise(0)
    copies = copies.select(
        "account_id", "company_id", "customer_id", F.explode(F.sequence(F.lit(0), last)).alias("_part"))
    return dealt.join(copies, ["account_id", "_part"], "left").select(
        "event_id", "event_name", F.col("distinct_id").alias("user_id"), "account_id", "event_at",
        "source_updated_at", "country", "channel", "workspace_id", "project_id", "task_id",
        "integration_type", "from_plan", "to_plan", "company_id", "customer_id",
    )


def fct_user_activation(activation: DataFrame) -> DataFrame:
    """Account, with the week and month of its signup."""
    return activation.withColumns({
        "signup_week": week_start("signup_at"), "signup_month": month_start("signup_at")})


def fct_user_daily_activity(activity: DataFrame) -> DataFrame:
    """User x account x day."""
    return activity.withColumn("is_active", F.col("event_count") > 0)


def fct_user_journey(events: DataFrame) -> DataFrame:
    """Account: first time of each onboarding step, whenever it happened."""
    def first(event: str) -> Column:
        return F.min(F.when(F.col("event_name") == event, F.col("event_at")))

    times = {f"{step}_at": event for step, event in JOURNEY_STEPS.items()}
    reached = events.groupBy("account_id").agg(
        first(SIGNUP_EVENT).alias("signup_at"),
        *[first(event).alias(column) for column, event in times.items()],
    )
    return reached.withColumns({
        f"reached_{step}": F.col(f"{step}_at").isNotNull() for step in JOURNEY_STEPS})


def fct_feature_adoption(feature_usage: DataFrame, activity: DataFrame) -> DataFrame:
    """Feature x week: accounts that used it, of the accounts active in that week.

    Both sides shrink to one row per (feature,) week before they meet. The usage
    has one row per account already, so counting rows counts accounts.
    """
    using = feature_usage.groupBy("feature_code", F.col("usage_week").alias("week")).agg(
        F.count("account_id").alias("accounts_using_feature"))
    active = (
        activity.select("account_id", week_start("activity_date").alias("week")).distinct()
        .groupBy("week").agg(F.count("account_id").alias("active_accounts"))
    )
    active_accounts = F.coalesce("active_accounts", F.lit(0))
    return using.join(active, "week", "left").select(
        "feature_code", "week", "accounts_using_feature",
        active_accounts.alias("active_accounts"),
        ratio(F.col("accounts_using_feature"), active_accounts).alias("adoption_rate"),
    )


def fct_subscription_history(history: DataFrame) -> DataFrame:
    """Subscription period, without the attributes of its price."""
    return history.drop("unit_amount", "billing_frequency", "monthly_unit_amount")


def mrr_levels(
    history: DataFrame, keys: list[str], as_of: str, include_end_month: bool = True, clamp_to_as_of: bool = False
) -> DataFrame:
    """Stretches of months (``first_month`` to ``last_month``) with one MRR per key, and the MRR of the stretch before.

    A paying period adds its amount in its first month and takes it away after
    its last, so it is two rows however long it lasts; the running sum of the
    changes, at most one row per key and month, is the level. Amounts are
    decimals: what was added is taken away without a rest. A period without an
    end runs to the month of ``as_of``; one that starts after its last month has
    none. By default the month of the end counts too, and an end after ``as_of``
    is kept.
    """
    today = F.lit(as_of).cast("date")
    end = F.coalesce(F.to_date("ended_at"), today)
    if clamp_to_as_of:
        end = F.least(end, today)
    if not include_end_month:
        end = F.when(F.col("ended_at").isNull(), end).otherwise(F.add_months(month_start(end), -1))
    amount = (F.col("seats") * F.col("monthly_unit_amount")).cast("decimal(28,10)")
    live = history.where((F.col("monthly_unit_amount") > 0) & (F.col("seats") > 0)).select(
        *keys, month_start("effective_at").alias("first"), month_start(end).alias("last"), amount.alias("amount"))
    changes = live.where(F.col("last") >= F.col("first")).select(*keys, F.inline(F.array(
        F.struct(F.col("first").alias("first_month"), F.col("amount").alias("change"), F.lit(1).alias("opened")),
        F.struct(F.add_months("last", 1).alias("first_month"), (-F.col("amount")).alias("change"), F.lit(-1).alias("opened")),
    )))
    changes = changes.groupBy(*keys, "first_month").agg(F.sum("change").alias("change"), F.sum("opened").alias("opened"))
    in_order = Window.partitionBy(*keys).orderBy("first_month")
    to_date = in_order.rowsBetween(Window.unboundedPreceding, 0)
    levels = changes.select(
        *keys, "first_month", F.add_months(F.lead("first_month").over(in_order), -1).alias("last_month"),
        F.sum("change").over(to_date).cast("double").alias("mrr"), F.sum("opened").over(to_date).alias("live"))
    levels = levels.where(F.col("live") > 0).drop("live")
    return levels.withColumn("mrr_before", F.lag("mrr").over(in_order))


def fct_account_mrr(history: DataFrame, as_of: str, **options: bool) -> DataFrame:
    """Account x month: MRR and its rise over the account's previous row."""
    levels = mrr_levels(history, ["account_id"], as_of, **options)
    rise = F.greatest(F.col("mrr") - F.coalesce("mrr_before", "mrr"), F.lit(0.0))
    months = levels.withColumn("rise", rise).select(
        "*", F.explode(month_spine(F.col("first_month"), F.col("last_month"))).alias("mrr_month"))
    return months.select("account_id", "mrr_month", "mrr", F.when(
        F.col("mrr_month") == F.col("first_month"), F.col("rise")).otherwise(F.lit(0.0)).alias("expansion_mrr"))


def fct_paid_conversion(identity: DataFrame, history: DataFrame) -> DataFrame:
    """Account: has it ever had a paid period?"""
    paid = (
        history.where(F.col("plan_code").isin(PAID_PLANS)).select("account_id").distinct()
        .withColumn("paid", F.lit(True))
    )
    return identity.join(paid, "account_id", "left").select(
        "account_id", F.coalesce("paid", F.lit(False)).alias("is_converted"))


def fct_churn(history: DataFrame) -> DataFrame:
    """Month: accounts with a live period taking effect in it, and those of them that also had one canceled in it.

    Both facts of a period are put in one column of months, so one pass and one
    shuffle on (account, month) replace two distincts and a join. An upgrade
    ends the old period as canceled and so counts as churn.
    """
    live = F.col("status").isin(LIVE_STATUSES)
    canceled = (F.col("status") == "canceled") & F.col("ended_at").isNotNull()

    def fact(condition: Column, month: Column, is_live: bool) -> Column:
        return F.when(condition, F.struct(month.alias("month"), F.lit(is_live).alias("is_live")))

    facts = F.array_compact(F.array(
        fact(live, month_start("effective_at"), True), fact(canceled, month_start("ended_at"), False)))
    return (
        history.select("account_id", F.inline(facts))
        .groupBy("account_id", "month")
        .agg(F.bool_or("is_live").alias("live"), F.bool_or(~F.col("is_live")).alias("churned"))
        .where("live")
        .groupBy("month")
        .agg(
            F.count("account_id").alias("active_at_start"),
            F.count(F.when(F.col("churned"), F.col("account_id"))).alias("churned_accounts"),
        )
        .withColumn("churn_rate", ratio(F.col("churned_accounts"), F.col("active_at_start")))
    )


def fct_retention(activation: DataFrame, active_weeks: DataFrame, split_by: tuple[str, ...] = ()) -> DataFrame:
    """Signup week x weeks since: share of the cohort active in that week.

    An account meets the two words of its week bitmap that its first weeks can
    lie in; whether it was active k weeks later is a bit of them, so a cohort is
    sums of bits. Weeks after the last one with activity are not listed, as they
    have not happened yet. ``split_by`` cuts the cohorts by more columns of the
    activation.
    """
    cohort = [*split_by, "cohort_week"]
    cohorts = activation.select("account_id", *split_by, week_start("signup_at").alias("cohort_week"))
    begin, word = week_number(F.col("cohort_week")), F.lit(WEEKS_PER_WORD)
    at = F.pmod(begin, word)
    words = cohorts.select(*cohort, "account_id", at.alias("at"), F.inline(F.array(
        F.struct(F.floor(begin / word).alias("era"), F.lit(False).alias("later")),
        F.struct((F.floor(begin / word) + 1).alias("era"), F.lit(True).alias("later")))))
    since = F.when(~F.col("later"), F.expr("shiftrightunsigned(weeks, at)")).when(
        F.col("at") > 0, F.expr(f"shiftleft(weeks, {WEEKS_PER_WORD} - at)")).otherwise(F.lit(0).cast("long"))
    offsets = range(LAST_RETENTION_WEEK + 1)
    sums = words.join(active_weeks, ["account_id", "era"]).withColumn("since", since).groupBy(*cohort).agg(
        *[F.sum(F.getbit("since", F.lit(k)).cast("long")).alias(f"after_{k}") for k in offsets])
    last = active_weeks.agg(F.max(last_week_number(F.col("era"), F.col("weeks")))).scalar()
    horizon = F.greatest(F.lit(0), F.coalesce(last - week_number(F.col("cohort_week")), F.lit(0))).cast("int")
    grid = cohorts.groupBy(*cohort).agg(F.count("account_id").alias("cohort_size"))
    listed = F.slice(F.array(*[
        F.struct(F.lit(k).alias("week_offset"), F.coalesce(f"after_{k}", F.lit(0)).alias("retained_accounts"))
        for k in offsets]), F.lit(1), F.least(F.lit(LAST_RETENTION_WEEK), horizon) + 1)
    return (
        grid.join(sums, cohort, "left").select(*cohort, "cohort_size", F.inline(listed))
        .select(
            *cohort, "week_offset", "cohort_size", "retained_accounts",
            ratio(F.col("retained_accounts"), F.col("cohort_size")).alias("retention_rate"),
        )
    )


def fct_usage_expansion(account_usage: DataFrame, account_mrr: DataFrame) -> DataFrame:
    """Account x month: product usage next to MRR; either may be missing."""
    usage = account_usage.withColumnRenamed("usage_month", "month")
    mrr = account_mrr.withColumnRenamed("mrr_month", "month")
    both = usage.join(mrr, ["account_id", "month"], "full_outer")
    return both.select(
        "account_id", "month",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_events", "feature_touches", "active_days")],
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("mrr", "expansion_mrr")],
        (F.coalesce("expansion_mrr", F.lit(0.0)) > 0).alias("is_expanding"),
    )


def fct_paid_base_daily(history: DataFrame) -> DataFrame:
    """Day: accounts that ever paid, accounts that left, and the difference.

    Counts the first paid start and the last canceled end of an account, so one
    that comes back is not counted again.
    """
    start, end = F.to_date("start_date"), F.to_date("ended_at")
    accounts = (
        history.where(F.col("plan_code").isin(PAID_PLANS))
        .groupBy("account_id")
        .agg(
            F.min(start).alias("first_paid"),
            F.max(F.when(F.col("status") == "canceled", end)).alias("churned"),
        )
    )
    # periods without an account form one group, whose end does not stretch the calendar
    changes = (
        accounts.select(F.inline(F.array(
            F.struct(F.col("first_paid").alias("day"), F.lit(1).alias("converted"), F.lit(0).alias("left"),
                     F.lit(True).alias("bounding")),
            F.struct(F.col("churned").alias("day"), F.lit(0).alias("converted"), F.lit(1).alias("left"),
                     F.col("account_id").isNotNull().alias("bounding")),
        )))
        .where(F.col("day").isNotNull())
        .groupBy("day")
        .agg(F.sum("converted").alias("converted"), F.sum("left").alias("left"),
             F.bool_or("bounding").alias("bounding"))
    )
    # at most one row per calendar day from here on: small enough for one task
    everything, to_date = Window.partitionBy(F.lit(0)), Window.orderBy("day")
    return (
        changes
        .withColumns({
            "from": F.min(F.when(F.col("converted") > 0, F.col("day"))).over(everything),
            "to": F.max(F.when(F.col("bounding"), F.col("day"))).over(everything),
        })
        .where(F.col("day").between(F.col("from"), F.col("to")))
        .select(
            "day",
            F.lead("day").over(to_date).alias("next_day"),
            F.sum("converted").over(to_date).alias("cum_converted"),
            F.sum("left").over(to_date).alias("cum_churned"),
        )
        # a day without changes has the totals of the day before it
        .select(
            F.explode(day_spine(F.col("day"), F.coalesce(F.date_sub("next_day", 1), F.col("day")))).alias("day_date"),
            "cum_converted", "cum_churned",
            (F.col("cum_converted") - F.col("cum_churned")).alias("paid_accounts"),
        )
    )
