"""Staging: one typed, standardised, deduplicated table per bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlake.functions.standardise import standard_country, standard_frequency, standard_plan
from growthlake.functions.vocabulary import FLATTENED_PROPERTIES
from growthlake.operators.ingest import delivery_content, delivery_order, first_per_key


def flatten_properties(events: DataFrame) -> DataFrame:
    """The common properties as columns, in place of the JSON text, which is parsed once for all of them."""
    parsed = F.from_json("properties", ", ".join(f"{name} string" for name in FLATTENED_PROPERTIES))
    return events.withColumn("properties", parsed).withColumns({
        name: F.col(f"properties.{name}") for name in FLATTENED_PROPERTIES
    }).drop("properties")


def stg_product_events(events: DataFrame) -> DataFrame:
    """First delivery of each event. Flattened before the shuffle, so unused properties are pruned away."""
    flat = flatten_properties(events.withColumn("_content", delivery_content()))
    unique = first_per_key(flat, ["event_id"], delivery_order(F.col("_content")))
    return unique.select(
        "event_id", "event_name", "distinct_id", "account_id", "event_at", "source_updated_at",
        *FLATTENED_PROPERTIES,
    )


def stg_crm_companies(companies: DataFrame) -> DataFrame:
    return companies.select(
        "company_id", "account_ref", "name", "industry", "company_size",
        standard_country("country").alias("country"),
        "lead_source", "lifecycle_stage", "source_updated_at",
    )


def stg_crm_contacts(contacts: DataFrame) -> DataFrame:
    return contacts.select(
        "contact_id", "company_id", "email", "first_name", "last_name", "lifecycle_stage", "source_updated_at"
    )


def stg_crm_deals(deals: DataFrame) -> DataFrame:
    return deals.select(
        "deal_id", "company_id", "deal_stage", "amount",
        F.to_date("close_date").alias("close_date"), "source_updated_at",
    )


def stg_billing_customers(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "account_ref", "email", "name", "source_updated_at")


def stg_billing_prices(prices: DataFrame) -> DataFrame:
    """``plan_code`` where the row has it, else the older ``plan``."""
    return prices.select(
        "price_id", "product_id",
        F.coalesce(standard_plan("plan_code"), standard_plan("plan")).alias("plan_code"),
        "unit_amount", "currency",
        standard_frequency("billing_frequency").alias("billing_frequency"),
        "source_updated_at",
    )


def stg_billing_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        "subscription_id", "customer_id", "price_id", "status", "seats",
        "start_date", "ended_at", "recorded_at", "effective_at", "source_updated_at",
    )


def stg_billing_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        "invoice_id", "customer_id", "subscription_id", "amount_due", "status", "created_at", "source_updated_at"
    )
