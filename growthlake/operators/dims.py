"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.functions.semantics import day_spine, iso_day_of_week, week_start
from growthlake.functions.vocabulary import FEATURE_LABELS


def current_plan(history: DataFrame, as_of: str | None = None) -> DataFrame:
    """Account -> plan of its latest period that has one; with ``as_of``, of those already in effect."""
    if as_of is not None:
        history = history.where(F.to_date("effective_at") <= F.lit(as_of).cast("date"))
    newest = F.struct("effective_at", "subscription_id")
    return history.where(F.col("plan_code").isNotNull()).groupBy("account_id").agg(
        F.max_by("plan_code", newest).alias("plan_code"))


def dim_accounts(
    identity: DataFrame, companies: DataFrame, history: DataFrame, as_of: str | None = None
) -> DataFrame:
    company = companies.select(
        "company_id", "name", "industry", "company_size", "country", "lead_source", "lifecycle_stage")
    return (
        identity.join(company, "company_id", "left")
        .join(current_plan(history, as_of), "account_id", "left")
        .select(
            "account_id", "company_id", "customer_id", "name", "industry", "company_size", "country",
            "lead_source", "lifecycle_stage", "plan_code", "crm_identity_missing", "billing_identity_missing",
        )
    )


def dim_dates(events: DataFrame) -> DataFrame:
    """One row per day from the first to the last event."""
    day = F.to_date("event_at")
    return (
        events.agg(F.min(day).alias("first"), F.max(day).alias("last"))
        .select(F.explode(day_spine(F.col("first"), F.col("last"))).alias("day_date"))
        .select(
            "day_date",
            F.col("day_date").alias("date_key"),
            F.year("day_date").alias("year"),
            F.quarter("day_date").alias("quarter"),
            F.month("day_date").alias("month"),
            week_start("day_date").alias("week_start"),
            iso_day_of_week("day_date").alias("day_of_week"),
            F.dayofmonth("day_date").alias("day_of_month"),
        )
    )


def dim_features(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FEATURE_LABELS.items()), "feature_code string, feature_name string")


def dim_plans(prices: DataFrame) -> DataFrame:
    return prices.select("price_id", "plan_code", "unit_amount", "billing_frequency")
