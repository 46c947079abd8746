"""Schemas of the bronze tables, as DDL strings. Timestamps are naive UTC."""

from __future__ import annotations

PRODUCT_EVENTS = (
    "event_id string, event_name string, distinct_id string, account_id string, "
    "event_at timestamp_ntz, source_updated_at timestamp_ntz, properties string, load_id string"
)
CRM_CONTACTS = (
    "contact_id string, company_id string, email string, first_name string, last_name string, "
    "lifecycle_stage string, source_updated_at timestamp_ntz"
)
CRM_COMPANIES = (
    "company_id string, account_ref string, name string, industry string, company_size string, "
    "country string, lead_source string, lifecycle_stage string, source_updated_at timestamp_ntz"
)
CRM_DEALS = (
    "deal_id string, company_id string, deal_stage string, amount double, "
    "close_date timestamp_ntz, source_updated_at timestamp_ntz"
)
BILLING_CUSTOMERS = (
    "customer_id string, account_ref string, email string, name string, source_updated_at timestamp_ntz"
)
BILLING_PRICES = (
    "price_id string, product_id string, plan string, plan_code string, unit_amount double, "
    "currency string, billing_frequency string, source_updated_at timestamp_ntz"
)
BILLING_SUBSCRIPTIONS = (
    "subscription_id string, customer_id string, price_id string, status string, seats int, "
    "start_date timestamp_ntz, ended_at timestamp_ntz, recorded_at timestamp_ntz, "
    "effective_at timestamp_ntz, source_updated_at timestamp_ntz"
)
BILLING_INVOICES = (
    "invoice_id string, customer_id string, subscription_id string, amount_due double, status string, "
    "created_at timestamp_ntz, source_updated_at timestamp_ntz"
)

BRONZE = {
    "product_events": PRODUCT_EVENTS,
    "crm_contacts": CRM_CONTACTS,
    "crm_companies": CRM_COMPANIES,
    "crm_deals": CRM_DEALS,
    "billing_customers": BILLING_CUSTOMERS,
    "billing_prices": BILLING_PRICES,
    "billing_subscriptions": BILLING_SUBSCRIPTIONS,
    "billing_invoices": BILLING_INVOICES,
}

# merge key per mutable collection; product_events is append-only and has none
MERGE_KEYS = {
    "crm_contacts": "contact_id",
    "crm_companies": "company_id",
    "crm_deals": "deal_id",
    "billing_customers": "customer_id",
    "billing_prices": "price_id",
    "billing_subscriptions": "subscription_id",
    "billing_invoices": "invoice_id",
}
