"""A hand-checkable fixture: four accounts and every data scenario. ``as_of`` is 2024-03-15."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from growthlake.operators.ingest import merge_latest, union_evolved
from growthlake.plans.warehouse import Warehouse
from growthlake.sources import schemas

AS_OF = "2024-03-15"


def at(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


EVENTS = [
    # account, event, time, arrival (None: at once)
    ("a", "account_created", "2024-01-01 09:00", None),
    ("a", "workspace_created", "2024-01-01 09:15", None),
    ("a", "project_created", "2024-01-01 09:35", None),
    ("a", "membership_invited", "2024-01-01 10:15", None),
    ("a", "task_created", "2024-01-01 12:15", None),
    ("a", "task_completed", "2024-01-01 15:15", None),
    ("b", "account_created", "2024-01-01 09:00", None),
    ("b", "workspace_created", "2024-01-01 09:15", None),
    ("b", "project_created", "2024-01-01 09:35", "2024-01-05 00:00"),
    ("b", "membership_invited", "2024-01-01 10:15", None),
    ("b", "task_created", "2024-01-02 09:00", None),
    ("b", "task_completed", "2024-01-09 09:00", None),
    ("c", "account_created", "2024-01-03 08:00", None),
    ("d", "workspace_created", "2024-01-10 08:00", None),
    ("d", "task_commented", "2024-01-11 08:00", None),
]


def events(spark: SparkSession) -> DataFrame:
    rows = [
        (f"evt_{i}", event, f"usr_{account}", f"acc_{account}", at(time), at(arrival or time),
         '{"k":1,"task_id":"tsk_1","country":"US"}', "0")
        for i, (account, event, time, arrival) in enumerate(EVENTS)
    ]
    # the completed task of account a is delivered again three days later
    again = rows[5][:5] + (at("2024-01-04 15:15"), rows[5][6], "1")
    return spark.createDataFrame([*rows, again], schemas.PRODUCT_EVENTS)


def company_loads(spark: SparkSession) -> list[DataFrame]:
    def rows(*items):
        return spark.createDataFrame([
            (f"cmp_{a}", f"acc_{a}", a.upper(), "SaaS", "1-10", country, "organic", stage, at(updated))
            for a, country, stage, updated in items
        ], schemas.CRM_COMPANIES)

    return [
        rows(("a", "USA", "customer", "2024-01-01"), ("b", "Canada", "lead", "2024-01-01"),
             ("d", "UK", "lead", "2024-01-01")),
        rows(("d", "UK", "churned", "2024-02-01")),
    ]


def contact_loads(spark: SparkSession) -> list[DataFrame]:
    def rows(*items):
        return spark.createDataFrame([
            (f"ctc_{a}", company, f"{a}@example.com", None, None, "lead", at(updated))
            for a, company, updated in items
        ], schemas.CRM_CONTACTS)

    return [
        rows(("a", "cmp_a", "2024-01-01"), ("b", "cmp_b", "2024-01-01"), ("d", None, "2024-01-01")),
        rows(("d", "cmp_d", "2024-01-20")),
    ]


def price_shapes(spark: SparkSession) -> list[DataFrame]:
    old = spark.createDataFrame(
        [("prc_free", "p", "Free", 0.0, "usd", "Monthly", at("2023-12-01")),
         ("prc_pro", "p", "PRO", 20.0, "usd", "month", at("2023-12-01"))],
        "price_id string, product_id string, plan string, unit_amount double, currency string, "
        "billing_frequency string, source_updated_at timestamp_ntz")
    new = spark.createDataFrame(
        [("prc_ent", "p", "ENT", "enterprise", 50.0, "usd", "monthly", at("2024-01-01")),
         ("prc_ent_year", "p", "ENT", "ENT", 600.0, "usd", "year", at("2024-01-01"))],
        schemas.BILLING_PRICES)
    return [old, new]


def subscriptions(spark: SparkSession) -> DataFrame:
    rows = [
        ("sub_1", "cus_a", "prc_free", "canceled", 1, "2024-01-01", "2024-01-10", "2024-01-01"),
        ("sub_2", "cus_a", "prc_pro", "superseded", 2, "2024-01-10", "2024-02-10", "2024-01-10"),
        ("sub_3", "cus_a", "prc_pro", "active", 5, "2024-02-10", None, "2024-02-10"),
        ("sub_4", "cus_b", "prc_pro", "active", 3, "2024-06-01", None, "2024-03-01"),
    ]
    return spark.createDataFrame([
        (i, customer, price, status, seats, at(start), at(end), at(recorded), at(start), at(recorded))
        for i, customer, price, status, seats, start, end, recorded in rows
    ], schemas.BILLING_SUBSCRIPTIONS)


def bronze(spark: SparkSession) -> dict[str, DataFrame]:
    customers = spark.createDataFrame(
        [(f"cus_{a}", f"acc_{a}", f"{a}@example.com", a, at("2024-01-01")) for a in "abcd"],
        schemas.BILLING_CUSTOMERS)
    deals = spark.createDataFrame(
        [("deal_1", "cmp_a", "closed_won", 10.0, at("2024-01-31 12:00"), at("2024-01-02"))], schemas.CRM_DEALS)
    invoices = spark.createDataFrame(
        [("inv_1", "cus_a", "sub_2", 40.0, "paid", at("2024-01-10"), at("2024-01-11"))], schemas.BILLING_INVOICES)
    return {
        "product_events": events(spark),
        "crm_companies": merge_latest(company_loads(spark), "company_id"),
        "crm_contacts": merge_latest(contact_loads(spark), "contact_id"),
        "crm_deals": deals,
        "billing_customers": customers,
        "billing_prices": union_evolved(price_shapes(spark)),
        "billing_subscriptions": subscriptions(spark),
        "billing_invoices": invoices,
    }


def warehouse(spark: SparkSession, root: str | None = None) -> Warehouse:
    return Warehouse(spark, bronze(spark).__getitem__, AS_OF, root)
