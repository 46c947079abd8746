"""DuckDB SQL for every query, written from the definitions and apart from the Spark side.

``VIEWS`` are named building blocks; an answer is put together from its text and
the blocks it mentions, in order, as one statement over the driver tables.
"""

from __future__ import annotations

import re

from growthlake.plans.warehouse import CORE, MARTS, MODELS, STAGING
from growthlake.sources.schemas import BRONZE


# fixed values, written out here too: a test that gets lost on the Spark side must show
_UNIQUE = dict(item.split(".") for item in """
    stg_product_events.event_id stg_crm_contacts.contact_id stg_crm_companies.company_id
    stg_crm_deals.deal_id stg_billing_customers.customer_id stg_billing_prices.price_id
    stg_billing_invoices.invoice_id int_identity_mapping.account_id int_user_activation.account_id
    dim_accounts.account_id dim_plans.price_id dim_features.feature_code
    dim_dates.day_date fct_product_events.event_id fct_user_activation.account_id
    fct_user_journey.account_id fct_paid_conversion.account_id fct_paid_base_daily.day_date
""".split())
_NOT_NULL = {
    "stg_product_events": "event_id event_name distinct_id account_id event_at".split(),
    "stg_crm_contacts": "contact_id email".split(),
    "stg_crm_companies": "company_id country".split(),
    "stg_crm_deals": "deal_id company_id".split(),
    "stg_billing_customers": "customer_id".split(),
    "stg_billing_prices": "price_id plan_code".split(),
    "stg_billing_subscriptions": "subscription_id customer_id".split(),
    "stg_billing_invoices": "invoice_id".split(),
    "int_identity_mapping": "account_id".split(),
    "int_user_activity": "user_id activity_date".split(),
    "int_user_activation": "account_id is_activated".split(),
    "int_feature_usage": "account_id feature_code".split(),
    "int_subscription_history": "subscription_id customer_id".split(),
    "int_account_usage": "account_id usage_month".split(),
    "dim_accounts": "account_id company_id customer_id".split(),
    "dim_plans": "price_id plan_code".split(),
    "dim_features": "feature_code".split(),
    "dim_dates": "day_date".split(),
    "fct_product_events": "event_id account_id event_at".split(),
    "fct_user_activation": "account_id is_activated".split(),
    "fct_user_daily_activity": "user_id activity_date".split(),
    "fct_feature_adoption": "feature_code week adoption_rate".split(),
    "fct_user_journey": "account_id".split(),
    "fct_subscription_history": "subscription_id effective_at".split(),
    "fct_account_mrr": "account_id mrr_month mrr".split(),
    "fct_paid_conversion": "account_id".split(),
    "fct_retention": "cohort_week week_offset retention_rate".split(),
    "fct_churn": "month churn_rate".split(),
    "fct_usage_expansion": "account_id month".split(),
    "fct_paid_base_daily": "day_date cum_converted cum_churned paid_accounts".split(),
}
_GRAINS = {
    "int_user_activity": "user_id account_id activity_date".split(),
    "int_account_usage": "account_id usage_month".split(),
    "int_feature_usage": "account_id feature_code usage_week".split(),
    "fct_feature_adoption": "feature_code week".split(),
    "fct_account_mrr": "account_id mrr_month".split(),
    "fct_retention": "cohort_week week_offset".split(),
    "fct_churn": "month".split(),
    "fct_usage_expansion": "account_id month".split(),
}


def _week(value: str) -> str:
    return f"(CAST({value} AS DATE) - CAST(dayofweek({value}) AS INTEGER))"


def _month(value: str) -> str:
    return f"CAST(date_trunc('month', {value}) AS DATE)"


def _money(value: str, aggregate: str = "") -> str:
    """Two places, rounded as a decimal: as a double, 76.835 would round by its last bits."""
    return f"CAST(round({aggregate}(CAST({value} AS DECIMAL(28, 10))), 2) AS DOUBLE)"


AS_OF = "DATE '2024-02-01'"
_ACTIVITY = """('workspace_created', 'project_created', 'task_created', 'task_assigned',
                'task_commented', 'task_completed', 'integration_connected')"""
_SIGNALS = "('workspace_created', 'project_created', 'membership_invited', 'task_completed')"
_DAY = "CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 140 AS INTEGER)"
_STAGE = "(['subscriber', 'lead', 'mql', 'sql', 'customer', 'churned'])[c_custkey % 6 + 1]"

VIEWS: dict[str, str] = {
    # bronze
    "o_events": f"""
        SELECT event_id AS n, user_id AS u, event_type AS kind,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               TIMESTAMP '2023-09-15 00:00:00' + (ts - TIMESTAMP '2024-01-01 00:00:00') * 4 AS happened
        FROM events""",
    "o_named": """
        SELECT n, k, happened, 'usr_' || u AS distinct_id,
               'acc_' || CASE u % 5 WHEN 0 THEN 10 * u + n % 10 WHEN 1 THEN 10 * u + n % 3
                                    ELSE 10 * (u - u % 2) END AS account_id,
               CASE kind
                 WHEN 'signup' THEN (['account_created', 'user_signup', 'membership_invited', 'plan_changed'])[k % 4 + 1]
                 WHEN 'view' THEN (['workspace_created', 'task_commented'])[k % 2 + 1]
                 WHEN 'click' THEN (['project_created', 'task_created'])[k % 2 + 1]
                 WHEN 'purchase' THEN (['integration_connected', 'task_completed', 'task_completed'])[k % 3 + 1]
                 ELSE 'task_assigned' END AS event_name
        FROM o_events""",
    "o_flat": """
        SELECT n, 'evt_' || n AS event_id, event_name, distinct_id, account_id, happened AS event_at, k,
               CASE WHEN event_name IN ('user_signup', 'account_created')
                    THEN (['US', 'CA', 'GB'])[k % 3 + 1] END AS country,
               CASE WHEN event_name IN ('user_signup', 'account_created')
                    THEN (['organic', 'paid', 'referral'])[k % 3 + 1] END AS channel,
               CASE WHEN event_name IN ('workspace_created', 'project_created', 'task_created')
                    THEN 'ws_' || k END AS workspace_id,
               CASE WHEN event_name IN ('project_created', 'task_created', 'task_completed')
                    THEN 'prj_' || k END AS project_id,
               CASE WHEN starts_with(event_name, 'task_') THEN 'tsk_' || k END AS task_id,
               CASE WHEN event_name = 'integration_connected'
                    THEN (['slack', 'github'])[k % 2 + 1] END AS integration_type,
               CASE WHEN event_name = 'plan_changed' THEN (['free', 'trial', 'pro'])[k % 3 + 1] END AS from_plan,
               CASE WHEN event_name = 'plan_changed' THEN (['trial', 'pro', 'enterprise'])[k % 3 + 1] END AS to_plan
        FROM o_named""",
    "o_delivered": """
        SELECT *, at_first AS source_updated_at, '0' AS load_id
        FROM (SELECT *, event_at + CASE WHEN n % 16 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 1 MINUTE END AS at_first
              FROM o_flat)
        UNION ALL
        SELECT *, event_at, event_at + INTERVAL 4 DAY, '1' FROM o_flat WHERE n % 25 = 0""",
    "bronze_product_events": """
        SELECT event_id, event_name, distinct_id, account_id, event_at, source_updated_at, load_id,
               '{"k":' || k
               || coalesce(',"country":"' || country || '"', '')
               || coalesce(',"channel":"' || channel || '"', '')
               || coalesce(',"workspace_id":"' || workspace_id || '"', '')
               || coalesce(',"project_id":"' || project_id || '"', '')
               || coalesce(',"task_id":"' || task_id || '"', '')
               || coalesce(',"integration_type":"' || integration_type || '"', '')
               || coalesce(',"from_plan":"' || from_plan || '"', '')
               || coalesce(',"to_plan":"' || to_plan || '"', '') || '}' AS properties
        FROM o_delivered""",
    "o_companies_first": f"""
        SELECT c_custkey, 'cmp_' || c_custkey AS company_id,
               CASE WHEN c_custkey % 19 <> 0 THEN 'acc_' || c_custkey END AS account_ref,
               c_name AS name, c_mktsegment AS industry,
               CASE WHEN c_acctbal < 1000 THEN '1-10' WHEN c_acctbal < 3000 THEN '11-50'
                    WHEN c_acctbal < 5000 THEN '51-200' WHEN c_acctbal < 8000 THEN '201-1000'
                    ELSE '1000+' END AS company_size,
               CASE WHEN c_nationkey = 24 THEN 'Germany'
                    ELSE ([['US', 'USA', 'United States'], ['CA', 'Canada', 'CAN'], ['GB', 'UK', 'United Kingdom']])
                         [c_nationkey % 3 + 1][c_custkey % 3 + 1] END AS country,
               (['organic', 'paid', 'referral', 'partner', 'outbound'])[c_custkey % 5 + 1] AS lead_source,
               {_STAGE} AS lifecycle_stage,
               TIMESTAMP '2023-09-01 00:00:00' + to_days(CAST(c_custkey % 90 AS INTEGER)) AS source_updated_at
        FROM customer""",
    "bronze_crm_companies": """
        SELECT company_id, account_ref, name, industry, company_size, country, lead_source,
               if(c_custkey % 10 = 0, 'churned', lifecycle_stage) AS lifecycle_stage,
               if(c_custkey % 10 = 0, TIMESTAMP '2024-01-15 00:00:00', source_updated_at) AS source_updated_at
        FROM o_companies_first""",
    "bronze_crm_contacts": f"""
        SELECT 'ctc_' || c_custkey AS contact_id,
               CASE WHEN c_custkey % 9 <> 0 OR c_custkey % 18 = 0 THEN 'cmp_' || c_custkey END AS company_id,
               'user' || c_custkey || '@example.com' AS email,
               CASE WHEN c_custkey % 7 <> 0 THEN 'Contact' END AS first_name,
               c_name AS last_name, {_STAGE} AS lifecycle_stage,
               CASE WHEN c_custkey % 18 = 0 THEN TIMESTAMP '2024-01-16 00:00:00'
                    ELSE TIMESTAMP '2023-09-02 00:00:00' + to_days(CAST(c_custkey % 90 AS INTEGER))
               END AS source_updated_at
        FROM customer""",
    "bronze_crm_deals": f"""
        SELECT 'deal_' || o_orderkey AS deal_id, 'cmp_' || o_custkey AS company_id,
               CASE o_orderstatus WHEN 'F' THEN 'closed_won' WHEN 'O' THEN 'new' ELSE 'trial' END AS deal_stage,
               o_totalprice AS amount,
               CASE WHEN o_orderstatus <> 'P' THEN TIMESTAMP '2023-10-01 12:00:00' + to_days({_DAY}) END AS close_date,
               TIMESTAMP '2023-09-01 06:00:00' + to_days({_DAY}) AS source_updated_at
        FROM orders""",
    "bronze_billing_customers": """
        SELECT 'cus_' || c_custkey AS customer_id,
               CASE WHEN c_custkey % 17 <> 0 THEN 'acc_' || c_custkey END AS account_ref,
               'billing' || c_custkey || '@example.com' AS email, c_name AS name,
               TIMESTAMP '2023-09-01 00:00:00' + to_days(CAST(c_custkey % 60 AS INTEGER)) AS source_updated_at
        FROM customer""",
    "bronze_billing_prices": """
        SELECT 'prc_' || p_partkey AS price_id, p_brand AS product_id,
               CASE WHEN p_partkey % 50 = 49 THEN 'Legacy'
                    ELSE ([['Free', 'FREE', 'free'], ['Trial', 'TRIAL', 'trial'], ['Pro', 'PRO', 'pro'],
                           ['Enterprise', 'ENT', 'enterprise'], ['Pro', 'PRO', 'pro']])
                         [p_partkey % 5 + 1][p_partkey % 3 + 1] END AS plan,
               CASE WHEN p_partkey % 2 = 0 THEN NULL WHEN p_partkey % 50 = 49 THEN 'legacy'
                    ELSE (['free', 'trial', 'pro', 'enterprise', 'pro'])[p_partkey % 5 + 1] END AS plan_code,
               CASE WHEN p_partkey % 5 IN (0, 1) THEN 0.0::DOUBLE
                    ELSE CAST(floor(p_retailprice) AS DOUBLE) / 100 END AS unit_amount,
               'usd' AS currency,
               CASE WHEN p_partkey % 5 = 4 THEN (['annual', 'Annual', 'year'])[p_partkey % 3 + 1]
                    ELSE (['monthly', 'Monthly', 'month'])[p_partkey % 3 + 1] END AS billing_frequency,
               CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2023-08-01 00:00:00'
                    ELSE TIMESTAMP '2023-09-30 00:00:00' END AS source_updated_at
        FROM part""",
    "o_orders": f"""
        SELECT *, {_DAY} AS day FROM orders""",
    "o_periods": """
        SELECT *, min(day) OVER (PARTITION BY o_custkey ORDER BY day
                                 RANGE BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_day
        FROM o_orders""",
    "bronze_billing_subscriptions": """
        SELECT subscription_id, customer_id, price_id, status, seats, start_date, ended_at,
               recorded_at, start_date AS effective_at, recorded_at + INTERVAL 1 HOUR AS source_updated_at
        FROM (SELECT *, start_date - CASE WHEN o_orderkey % 10 = 0 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END
                        AS recorded_at
              FROM (SELECT o_orderkey, 'sub_' || o_orderkey AS subscription_id, 'cus_' || o_custkey AS customer_id,
                           'prc_' || coalesce((SELECT min(l_partkey) FROM lineitem WHERE l_orderkey = o_orderkey),
                                              o_custkey) AS price_id,
                           CASE WHEN next_day IS NULL AND o_orderstatus = 'F' THEN 'canceled'
                                WHEN next_day IS NOT NULL AND o_orderkey % 7 = 0 THEN 'canceled'
                                WHEN next_day IS NOT NULL THEN 'superseded'
                                WHEN o_orderpriority LIKE '4%' THEN 'trialing'
                                WHEN o_orderpriority LIKE '5%' AND o_orderstatus = 'P' THEN 'past_due'
                                ELSE 'active' END AS status,
                           CAST(1 + o_orderkey % 10 AS INTEGER) AS seats,
                           TIMESTAMP '2023-09-01 00:00:00'
                             + to_days(day + CASE WHEN o_orderkey % 97 = 0 THEN 365 ELSE 0 END)
                             + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS start_date,
                           CASE WHEN next_day IS NOT NULL THEN TIMESTAMP '2023-09-01 00:00:00' + to_days(next_day)
                                WHEN o_orderstatus = 'F' THEN TIMESTAMP '2023-09-16 00:00:00' + to_days(day)
                                WHEN o_orderkey % 13 = 0 THEN TIMESTAMP '2024-06-01 00:00:00'
                           END AS ended_at
                    FROM o_periods))""",
    "bronze_billing_invoices": """
        SELECT 'inv_' || o_orderkey AS invoice_id, 'cus_' || o_custkey AS customer_id,
               'sub_' || o_orderkey AS subscription_id, amount_due,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'void' END AS status,
               TIMESTAMP '2023-09-01 00:00:00' + to_days(day) AS created_at,
               TIMESTAMP '2023-09-02 00:00:00' + to_days(day) AS source_updated_at
        FROM o_orders
        JOIN (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(12, 2))
                                          * (1 - CAST(l_discount AS DECIMAL(4, 2)))) AS DOUBLE) AS amount_due
              FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey""",

    # staging
    "stg_product_events": """
        SELECT event_id, event_name, distinct_id, account_id, event_at, source_updated_at, country, channel,
               workspace_id, project_id, task_id, integration_type, from_plan, to_plan
        FROM o_delivered
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY source_updated_at, load_id) = 1""",
    "stg_crm_companies": """
        SELECT * REPLACE (CASE WHEN upper(country) IN ('US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA') THEN 'US'
                               WHEN upper(country) IN ('CA', 'CAN', 'CANADA') THEN 'CA'
                               WHEN upper(country) IN ('GB', 'UK', 'UNITED KINGDOM') THEN 'GB'
                               ELSE country END AS country)
        FROM bronze_crm_companies""",
    "stg_crm_contacts": "SELECT * FROM bronze_crm_contacts",
    "stg_crm_deals": "SELECT * REPLACE (CAST(close_date AS DATE) AS close_date) FROM bronze_crm_deals",
    "stg_billing_customers": "SELECT * FROM bronze_billing_customers",
    "stg_billing_prices": """
        SELECT price_id, product_id,
               replace(lower(coalesce(plan_code, if(plan = 'ENT', 'enterprise', plan))), ' ', '') AS plan_code,
               unit_amount, currency,
               CASE WHEN lower(billing_frequency) LIKE 'month%' THEN 'monthly' ELSE 'annual' END AS billing_frequency,
               source_updated_at
        FROM bronze_billing_prices""",
    "stg_billing_subscriptions": "SELECT * FROM bronze_billing_subscriptions",
    "stg_billing_invoices": "SELECT * FROM bronze_billing_invoices",

    # core
    "int_identity_mapping": """
        SELECT account_id, company_id, customer_id,
               company_id IS NULL AS crm_identity_missing, customer_id IS NULL AS billing_identity_missing
        FROM (SELECT DISTINCT account_id FROM stg_product_events WHERE account_id IS NOT NULL) a
        LEFT JOIN stg_crm_companies c ON c.account_ref = a.account_id
        LEFT JOIN stg_billing_customers b ON b.account_ref = a.account_id""",
    "o_activity": f"SELECT * FROM stg_product_events WHERE event_name IN {_ACTIVITY}",
    "int_user_activity": """
        SELECT distinct_id AS user_id, account_id, CAST(event_at AS DATE) AS activity_date,
               count(*) AS event_count, count(DISTINCT event_name) AS distinct_features
        FROM o_activity GROUP BY ALL""",
    "int_account_usage": f"""
        SELECT account_id, {_month('activity_date')} AS usage_month,
               CAST(sum(event_count) AS BIGINT) AS total_events,
               CAST(sum(distinct_features) AS BIGINT) AS feature_touches,
               count(DISTINCT activity_date) AS active_days
        FROM int_user_activity GROUP BY ALL""",
    "int_feature_usage": f"""
        SELECT account_id,
               CASE event_name WHEN 'workspace_created' THEN 'workspace' WHEN 'project_created' THEN 'projects'
                    WHEN 'task_commented' THEN 'comments' WHEN 'integration_connected' THEN 'integrations'
                    ELSE 'tasks' END AS feature_code,
               {_week('event_at')} AS usage_week, count(*) AS event_count
        FROM o_activity GROUP BY ALL""",
    "o_signups": """
        SELECT account_id, min(event_at) AS signup_at FROM stg_product_events
        WHERE event_name = 'account_created' GROUP BY ALL""",
    "int_user_activation": """
        SELECT account_id, signup_at, workspace_at, project_at, invite_at, task_done_at,
               coalesce(list_max([workspace_at, project_at, invite_at, task_done_at]),
                        TIMESTAMP '1970-01-01 00:00:00') AS activation_at,
               workspace_at IS NOT NULL AND project_at IS NOT NULL
                 AND invite_at IS NOT NULL AND task_done_at IS NOT NULL AS is_activated,
               CAST(date_diff('day', signup_at, coalesce(
                 list_max([workspace_at, project_at, invite_at, task_done_at]),
                 TIMESTAMP '1970-01-01 00:00:00')) AS INTEGER) AS time_to_activation_days
        FROM (SELECT s.account_id, s.signup_at,
                     max(event_at) FILTER (event_name = 'workspace_created') AS workspace_at,
                     max(event_at) FILTER (event_name = 'project_created') AS project_at,
                     max(event_at) FILTER (event_name = 'membership_invited') AS invite_at,
                     max(event_at) FILTER (event_name = 'task_completed') AS task_done_at
              FROM o_signups s
              LEFT JOIN stg_product_events e
                ON e.account_id = s.account_id AND e.event_at <= s.signup_at + INTERVAL 7 DAY
              GROUP BY ALL)""",
    "int_subscription_history": """
        SELECT subscription_id, s.customer_id, account_ref AS account_id, s.price_id, plan_code, status, seats,
               unit_amount, billing_frequency,
               if(billing_frequency = 'annual', unit_amount / 12, unit_amount) AS monthly_unit_amount,
               start_date, ended_at, recorded_at, effective_at, s.source_updated_at
        FROM stg_billing_subscriptions s
        LEFT JOIN stg_billing_prices p ON p.price_id = s.price_id
        LEFT JOIN stg_billing_customers c ON c.customer_id = s.customer_id""",

    # dimensions
    "o_plan_now": """
        SELECT account_id, plan_code FROM int_subscription_history WHERE plan_code IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY effective_at DESC, subscription_id DESC) = 1""",
    "dim_accounts": """
        SELECT i.account_id, i.company_id, i.customer_id, c.name, c.industry, c.company_size, c.country,
               c.lead_source, c.lifecycle_stage, p.plan_code, i.crm_identity_missing, i.billing_identity_missing
        FROM int_identity_mapping i
        LEFT JOIN stg_crm_companies c ON c.company_id = i.company_id
        LEFT JOIN o_plan_now p ON p.account_id = i.account_id""",
    "dim_dates": f"""
        SELECT day_date, day_date AS date_key, CAST(year(day_date) AS INTEGER) AS year,
               CAST(quarter(day_date) AS INTEGER) AS quarter, CAST(month(day_date) AS INTEGER) AS month,
               {_week('day_date')} AS week_start, CAST(isodow(day_date) AS INTEGER) AS day_of_week,
               CAST(day(day_date) AS INTEGER) AS day_of_month
        FROM (SELECT CAST(unnest(generate_series(min(CAST(event_at AS DATE)), max(CAST(event_at AS DATE)),
                                                 INTERVAL 1 DAY)) AS DATE) AS day_date
              FROM stg_product_events)""",
    "o_features": """
        SELECT * FROM (VALUES ('workspace', 'Workspace'), ('projects', 'Projects'), ('tasks', 'Tasks'),
                              ('comments', 'Comments'), ('integrations', 'Integrations')) AS f(feature_code, feature_name)""",
    "dim_plans": "SELECT price_id, plan_code, unit_amount, billing_frequency FROM stg_billing_prices",

    # facts
    "fct_product_events": """
        SELECT e.* RENAME (distinct_id AS user_id), i.company_id, i.customer_id
        FROM stg_product_events e LEFT JOIN int_identity_mapping i USING (account_id)""",
    "fct_user_activation": f"""
        SELECT *, {_week('signup_at')} AS signup_week, {_month('signup_at')} AS signup_month
        FROM int_user_activation""",
    "fct_user_daily_activity": "SELECT *, event_count > 0 AS is_active FROM int_user_activity",
    "fct_user_journey": """
        SELECT *, workspace_at IS NOT NULL AS reached_workspace, project_at IS NOT NULL AS reached_project,
               invite_at IS NOT NULL AS reached_invite, task_created_at IS NOT NULL AS reached_task_created,
               task_completed_at IS NOT NULL AS reached_task_completed
        FROM (SELECT account_id,
                     min(event_at) FILTER (event_name = 'account_created') AS signup_at,
                     min(event_at) FILTER (event_name = 'workspace_created') AS workspace_at,
                     min(event_at) FILTER (event_name = 'project_created') AS project_at,
                     min(event_at) FILTER (event_name = 'membership_invited') AS invite_at,
                     min(event_at) FILTER (event_name = 'task_created') AS task_created_at,
                     min(event_at) FILTER (event_name = 'task_completed') AS task_completed_at
              FROM stg_product_events GROUP BY ALL)""",
    "fct_feature_adoption": f"""
        SELECT feature_code, week, accounts_using_feature, active_accounts,
               accounts_using_feature / nullif(active_accounts, 0) AS adoption_rate
        FROM (SELECT feature_code, usage_week AS week, count(DISTINCT account_id) AS accounts_using_feature,
                     (SELECT count(DISTINCT a.account_id) FROM int_user_activity a
                      WHERE {_week('a.activity_date')} = usage_week) AS active_accounts
              FROM int_feature_usage GROUP BY feature_code, usage_week)""",
    "fct_subscription_history": """
        SELECT * EXCLUDE (unit_amount, billing_frequency, monthly_unit_amount) FROM int_subscription_history""",
    "o_live_months": f"""
        SELECT *, CAST(unnest(generate_series({_month('effective_at')},
                                              {_month(f'coalesce(CAST(ended_at AS DATE), {AS_OF})')},
                                              INTERVAL 1 MONTH)) AS DATE) AS mrr_month
        FROM int_subscription_history WHERE monthly_unit_amount > 0 AND seats > 0""",
    "fct_account_mrr": """
        SELECT *, greatest(mrr - coalesce(lag(mrr) OVER (PARTITION BY account_id ORDER BY mrr_month), mrr), 0)
                  AS expansion_mrr
        FROM (SELECT account_id, mrr_month,
                     CAST(sum(CAST(seats * monthly_unit_amount AS DECIMAL(28, 10))) AS DOUBLE) AS mrr
              FROM o_live_months GROUP BY ALL)""",
    "fct_paid_conversion": """
        SELECT account_id, account_id IN (SELECT account_id FROM int_subscription_history
                                          WHERE plan_code IN ('pro', 'enterprise') AND account_id IS NOT NULL)
                           AS is_converted
        FROM int_identity_mapping""",
    "fct_churn": f"""
        SELECT month, count(DISTINCT a.account_id) AS active_at_start, count(DISTINCT c.account_id) AS churned_accounts,
               count(DISTINCT c.account_id) / nullif(count(DISTINCT a.account_id), 0) AS churn_rate
        FROM (SELECT account_id, {_month('effective_at')} AS month FROM int_subscription_history
              WHERE status IN ('active', 'trialing', 'past_due')) a
        LEFT JOIN (SELECT DISTINCT account_id, {_month('ended_at')} AS month FROM int_subscription_history
                   WHERE status = 'canceled' AND ended_at IS NOT NULL) c USING (account_id, month)
        GROUP BY month""",
    "o_cohorts": f"SELECT account_id, is_activated, {_week('signup_at')} AS cohort_week FROM int_user_activation",
    "o_weekly": f"SELECT DISTINCT account_id, {_week('activity_date')} AS activity_week FROM int_user_activity",
    "fct_retention": """
        SELECT cohort_week, week_offset, cohort_size,
               count(DISTINCT w.account_id) AS retained_accounts,
               count(DISTINCT w.account_id) / nullif(cohort_size, 0) AS retention_rate
        FROM (SELECT cohort_week, CAST(unnest(range(13)) AS INTEGER) AS week_offset,
                     count(DISTINCT account_id) AS cohort_size FROM o_cohorts GROUP BY cohort_week) g
        JOIN o_cohorts m USING (cohort_week)
        LEFT JOIN o_weekly w ON w.account_id = m.account_id AND w.activity_week = cohort_week + 7 * week_offset
        WHERE week_offset <= greatest(0, ((SELECT max(activity_week) FROM o_weekly) - cohort_week) // 7)
        GROUP BY cohort_week, week_offset, cohort_size""",
    "fct_usage_expansion": """
        SELECT coalesce(u.account_id, m.account_id) AS account_id, coalesce(usage_month, mrr_month) AS month,
               coalesce(total_events, 0) AS total_events, coalesce(feature_touches, 0) AS feature_touches,
               coalesce(active_days, 0) AS active_days, coalesce(mrr, 0) AS mrr,
               coalesce(expansion_mrr, 0) AS expansion_mrr, coalesce(expansion_mrr, 0) > 0 AS is_expanding
        FROM int_account_usage u
        FULL JOIN fct_account_mrr m ON m.account_id = u.account_id AND mrr_month = usage_month""",
    "o_paid_accounts": """
        SELECT account_id, min(CAST(start_date AS DATE)) AS first_paid,
               max(CAST(ended_at AS DATE)) FILTER (status = 'canceled') AS left_at
        FROM int_subscription_history WHERE plan_code IN ('pro', 'enterprise') GROUP BY ALL""",
    "fct_paid_base_daily": """
        SELECT day_date, cum_converted, cum_churned, cum_converted - cum_churned AS paid_accounts
        FROM (SELECT day_date,
                     (SELECT count(*) FROM o_paid_accounts WHERE first_paid <= day_date) AS cum_converted,
                     (SELECT count(*) FROM o_paid_accounts
                      WHERE left_at <= day_date AND left_at >= (SELECT min(first_paid) FROM o_paid_accounts))
                       AS cum_churned
              FROM (SELECT CAST(unnest(generate_series(
                             min(first_paid),
                             max(greatest(first_paid, CASE WHEN account_id IS NOT NULL THEN left_at END)),
                             INTERVAL 1 DAY)) AS DATE) AS day_date
                    FROM o_paid_accounts))""",

    # reports other answers build on
    "onboarding_funnel": """
        SELECT CAST(step_number AS INTEGER) AS step_number, step, accounts
        FROM (SELECT unnest(range(1, 7)) AS step_number,
                     unnest(['Signup', 'Workspace created', 'Project created', 'Teammate invited',
                             'Task created', 'Task completed']) AS step,
                     unnest([count(*), count(workspace_at), count(project_at), count(invite_at),
                             count(task_created_at), count(task_completed_at)]) AS accounts
              FROM fct_user_journey)""",
    "dau_wau": """
        SELECT activity_date, dau, wau, round(dau / wau, 4) AS stickiness
        FROM (SELECT d.activity_date,
                     count(DISTINCT a.user_id) FILTER (a.activity_date = d.activity_date) AS dau,
                     count(DISTINCT a.user_id) AS wau
              FROM (SELECT DISTINCT activity_date FROM int_user_activity) d
              JOIN (SELECT DISTINCT user_id, activity_date FROM int_user_activity) a
                ON a.activity_date BETWEEN d.activity_date - 6 AND d.activity_date
              GROUP BY ALL)""",
    "retention_cohort": "SELECT * REPLACE (round(retention_rate, 4) AS retention_rate) FROM fct_retention",
    "recent_cohorts": """
        SELECT * FROM retention_cohort
        WHERE cohort_week >= (SELECT max(cohort_week) FROM retention_cohort) - 35""",
    "activation_vs_activity": """
        SELECT a.account_id, is_activated, coalesce(n, 0) AS active_weeks
        FROM int_user_activation a
        LEFT JOIN (SELECT account_id, count(*) AS n FROM o_weekly GROUP BY ALL) w ON w.account_id = a.account_id""",
    "mrr_overview": f"""
        SELECT mrr_month, {_money('mrr', 'sum')} AS total_mrr,
               count(DISTINCT account_id) AS paying_accounts,
               {_money('expansion_mrr', 'sum')} AS expansion_mrr
        FROM fct_account_mrr GROUP BY mrr_month""",
    "o_usage": "SELECT account_id, count(*) AS total_events FROM fct_product_events GROUP BY ALL",
    "metric_engagement_segment": """
        SELECT account_id, total_events,
               CASE WHEN total_events >= 50 THEN 'high' WHEN total_events >= 10 THEN 'medium' ELSE 'low' END
               AS engagement_segment
        FROM o_usage""",
}

_SHARE_STEPS = """round(accounts / nullif(first_value(accounts) OVER w, 0), 4) AS share_of_first,
                  round(accounts / nullif(lag(accounts) OVER w, 0), 4) AS share_of_previous"""


def _flag_slice(fact: str, flag: str, hits: str, rate: str, columns: str) -> str:
    keys = ", ".join(part.split(" AS ")[-1] for part in columns.split(", "))
    return f"""
        SELECT {columns}, count(*) AS accounts, count(*) FILTER ({flag}) AS {hits},
               round(avg(CAST({flag} AS INTEGER)), 4) AS {rate}
        FROM {fact} f JOIN dim_accounts d ON d.account_id = f.account_id GROUP BY {keys}"""


def _activation(columns: str) -> str:
    return _flag_slice("fct_user_activation", "is_activated", "activated", "activation_rate", columns)


def _conversion(columns: str) -> str:
    return _flag_slice("fct_paid_conversion", "is_converted", "converted", "conversion_rate", columns)


def _latest_mrr(column: str) -> str:
    return f"""
        SELECT {column}, {_money('mrr', 'sum')} AS mrr,
               count(DISTINCT m.account_id) AS paying_accounts
        FROM fct_account_mrr m JOIN dim_accounts d ON d.account_id = m.account_id
        WHERE mrr_month = (SELECT max(mrr_month) FROM fct_account_mrr) GROUP BY {column}"""


def _none_found(table: str, condition: str) -> str:
    return f"SELECT count(*) AS n FROM {table} WHERE {condition} HAVING count(*) = 0"


DQ: dict[str, str] = {
    "dq_activation_after_signup": "SELECT * FROM fct_user_activation WHERE is_activated AND signup_at > activation_at",
    "dq_activation_rate_bounded": """
        SELECT signup_week, count(*) AS total, count(*) FILTER (is_activated) AS activated FROM fct_user_activation
        GROUP BY signup_week HAVING count(*) FILTER (is_activated) > count(*)""",
    "dq_activation_within_window":
        "SELECT * FROM fct_user_activation WHERE is_activated AND time_to_activation_days > 7",
    "dq_churn_rate_bounded": "SELECT * FROM fct_churn WHERE churn_rate NOT BETWEEN 0 AND 1",
    "dq_country_standardised": "SELECT * FROM stg_crm_companies WHERE country NOT IN ('US', 'CA', 'GB')",
    "dq_expansion_non_negative": "SELECT * FROM fct_account_mrr WHERE expansion_mrr < 0",
    "dq_adoption_rate_bounded": "SELECT * FROM fct_feature_adoption WHERE adoption_rate NOT BETWEEN 0 AND 1",
    "dq_future_effective": f"SELECT * FROM fct_account_mrr WHERE mrr_month > {_month(AS_OF)}",
    "dq_journey_monotonic": """
        SELECT * FROM fct_user_journey
        WHERE (project_at IS NOT NULL AND workspace_at IS NULL) OR (task_created_at IS NOT NULL AND project_at IS NULL)
           OR (task_completed_at IS NOT NULL AND task_created_at IS NULL)""",
    "dq_late_crm_applied": _none_found("stg_crm_companies", "lifecycle_stage IN ('customer', 'churned')"),
    "dq_late_events_backfilled": _none_found(
        "fct_product_events", "source_updated_at - event_at > INTERVAL 1 HOUR"),
    "dq_lifecycle_transition": _none_found("stg_crm_companies", "lifecycle_stage = 'churned'"),
    "dq_missing_association": """
        SELECT count(company_id) AS linked, count(*) AS total FROM stg_crm_contacts
        HAVING count(company_id) = 0 OR 2 * count(company_id) < count(*)""",
    "dq_mrr_non_negative": "SELECT * FROM fct_account_mrr WHERE mrr < 0",
    "dq_no_duplicate_events":
        "SELECT event_id, count(*) AS n FROM fct_product_events GROUP BY event_id HAVING count(*) > 1",
    "dq_plan_code_populated": """
        SELECT * FROM stg_billing_prices WHERE coalesce(plan_code, '') NOT IN ('free', 'trial', 'pro', 'enterprise')""",
    "dq_retention_rate_bounded": "SELECT * FROM fct_retention WHERE retention_rate NOT BETWEEN 0 AND 1",
    "dq_subscription_dates": "SELECT * FROM fct_subscription_history WHERE start_date > ended_at",
    "dq_history_append_only": _none_found("fct_subscription_history", "status = 'superseded'"),
}


def _dims(name: str) -> str:
    # the registered feature dimension carries counts; as a table it has its two columns only
    return "o_features" if name == "dim_features" else name


def _generic(tables: list[str]) -> str:
    parts = []
    for name in tables:
        for column in _NOT_NULL[name]:
            parts.append(
                f"SELECT '{name}' AS table_name, 'not_null' AS test, '{column}' AS column_name, "
                f"count(*) - count({column}) AS violations FROM {_dims(name)}")
        if name in _UNIQUE:
            key = _UNIQUE[name]
            parts.append(
                f"SELECT '{name}', 'unique', '{key}', count(*) FROM (SELECT {key} FROM {_dims(name)} "
                f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)")
    return " UNION ALL ".join(parts)


def _spelling(table: str, column: str, standard: str) -> str:
    return f"SELECT {column} AS spelling, {standard} AS standard, count(*) AS n FROM {table} GROUP BY ALL"


def _event_days(expression: str, name: str) -> str:
    return f"""
        SELECT day, {expression} AS {name}, count(*) AS n
        FROM (SELECT CAST(event_at AS DATE) AS day FROM bronze_product_events) GROUP BY ALL"""


def _new_per_day(event: str, counted: str, name: str, more: str = "") -> str:
    return f"""
        SELECT CAST(event_at AS DATE) AS day{more}, count(DISTINCT {counted}) AS {name}
        FROM stg_product_events WHERE event_name = '{event}' GROUP BY ALL"""


ANSWERS: dict[str, str] = {
    **{f"bronze_{name}": f"SELECT * FROM bronze_{name}" for name in BRONZE},
    **{name: f"SELECT * FROM {name}" for name in MODELS if name != "dim_features"},
    **DQ,

    # reports
    "kpis": """
        SELECT (SELECT count(*) FROM fct_user_activation) AS total_accounts,
               (SELECT count(*) FROM fct_user_activation WHERE is_activated) AS activated_accounts,
               (SELECT round(avg(is_activated::INT), 4) FROM fct_user_activation) AS activation_rate,
               (SELECT count(*) FROM fct_paid_conversion WHERE is_converted) AS converted_accounts,
               (SELECT round(avg(is_converted::INT), 4) FROM fct_paid_conversion) AS paid_conversion_rate,
               (SELECT total_mrr FROM mrr_overview ORDER BY mrr_month DESC LIMIT 1) AS latest_month_mrr,
               (SELECT count(*) FROM fct_product_events) AS total_events,
               (SELECT round(avg(adoption_rate), 4) FROM fct_feature_adoption) AS avg_feature_adoption""",
    "activation_rate": """
        SELECT signup_week AS cohort, count(*) AS accounts, count(*) FILTER (is_activated) AS activated,
               round(avg(is_activated::INT), 4) AS activation_rate
        FROM fct_user_activation GROUP BY signup_week""",
    "activation_by_country": _activation("country"),
    "activation_by_industry": _activation("industry"),
    "activation_by_plan": _activation("plan_code AS plan"),
    "activation_by_size": _activation("company_size"),
    "activation_by_country_plan": _activation("country, plan_code"),
    "conversion_by_country": _conversion("country"),
    "conversion_by_industry": _conversion("industry"),
    "time_to_activation": """
        SELECT round(quantile_cont(time_to_activation_days, 0.25), 2) AS p25_days,
               round(quantile_cont(time_to_activation_days, 0.5), 2) AS p50_days,
               round(quantile_cont(time_to_activation_days, 0.9), 2) AS p90_days,
               round(avg(time_to_activation_days), 2) AS avg_days, count(*) AS activated_accounts
        FROM fct_user_activation WHERE is_activated""",
    "time_to_activation_distribution": """
        SELECT time_to_activation_days, count(*) AS accounts FROM fct_user_activation WHERE is_activated GROUP BY 1""",
    "activation_vs_activity": "SELECT * FROM activation_vs_activity",
    "avg_active_weeks_by_activation": """
        SELECT is_activated, round(avg(active_weeks), 4) AS avg_active_weeks
        FROM activation_vs_activity GROUP BY is_activated""",
    "onboarding_funnel": "SELECT * FROM onboarding_funnel",
    "funnel_table": "SELECT step, accounts FROM onboarding_funnel",
    "funnel_percent": """
        SELECT step_number, step, accounts,
               round(accounts / (SELECT max(accounts) FROM onboarding_funnel WHERE step_number = 1), 4) AS share_of_first
        FROM onboarding_funnel""",
    "dau_wau": "SELECT * FROM dau_wau",
    "dau_wau_sketched": "SELECT activity_date, dau, wau, true AS dau_within, true AS wau_within FROM dau_wau",
    "avg_dau_stickiness":
        "SELECT round(avg(dau), 4) AS avg_dau, round(avg(stickiness), 4) AS avg_stickiness FROM dau_wau",
    "feature_adoption": """
        SELECT feature_code, round(avg(adoption_rate), 4) AS avg_adoption_rate,
               CAST(sum(accounts_using_feature) AS BIGINT) AS accounts_using_feature
        FROM fct_feature_adoption GROUP BY feature_code""",
    "feature_adoption_trend": "SELECT week, feature_code, adoption_rate FROM fct_feature_adoption",
    "paid_conversion": """
        SELECT coalesce(a.is_activated, false) AS is_activated, count(*) AS accounts,
               count(*) FILTER (c.is_converted) AS converted, round(avg(c.is_converted::INT), 4) AS conversion_rate
        FROM fct_paid_conversion c LEFT JOIN int_user_activation a ON a.account_id = c.account_id GROUP BY 1""",
    "conversion_by_engagement": """
        SELECT coalesce(engagement_segment, 'low') AS engagement_segment, count(*) AS accounts,
               count(*) FILTER (is_converted) AS converted, round(avg(is_converted::INT), 4) AS conversion_rate
        FROM fct_paid_conversion LEFT JOIN metric_engagement_segment USING (account_id) GROUP BY 1""",
    "retention_cohort": "SELECT * FROM retention_cohort",
    "recent_cohorts": "SELECT * FROM recent_cohorts",
    "recent_cohort_retention": """
        SELECT cohort_week, week_offset, round(avg(retention_rate), 4) AS avg_retention_rate
        FROM recent_cohorts GROUP BY ALL""",
    "churn_overview": "SELECT * REPLACE (round(churn_rate, 4) AS churn_rate) FROM fct_churn",
    "churn_by_usage": """
        SELECT if(account_id IN (SELECT account_id FROM int_subscription_history
                                 WHERE status = 'canceled' AND account_id IS NOT NULL),
                  'churned', 'retained') AS segment,
               count(account_id) AS accounts, round(avg(e), 1) AS avg_events, round(avg(d), 1) AS avg_active_days
        FROM (SELECT account_id, sum(total_events) AS e, sum(active_days) AS d FROM fct_usage_expansion GROUP BY ALL)
        GROUP BY 1""",
    "mrr_overview": "SELECT * FROM mrr_overview",
    "peak_mrr": "SELECT max(total_mrr) AS peak_mrr FROM mrr_overview",
    "mrr_by_country": _latest_mrr("country"),
    "mrr_by_size": _latest_mrr("company_size"),
    "expansion_accounts": f"""
        SELECT account_id, month, {_money('mrr')} AS mrr, {_money('expansion_mrr')} AS expansion_mrr,
               total_events, active_days
        FROM fct_usage_expansion WHERE is_expanding""",
    "usage_vs_mrr": f"""
        SELECT account_id, month, total_events, active_days, {_money('mrr')} AS mrr,
               {_money('expansion_mrr')} AS expansion_mrr, is_expanding
        FROM fct_usage_expansion""",
    "paid_base": "SELECT * FROM fct_paid_base_daily",

    # metrics
    "metric_new_users": _new_per_day("user_signup", "distinct_id", "new_users"),
    "metric_new_users_by_segment": _new_per_day("user_signup", "distinct_id", "new_users", ", country, channel"),
    "metric_new_accounts": _new_per_day("account_created", "account_id", "new_accounts"),
    "metric_funnel_conversion": f"""
        SELECT *, {_SHARE_STEPS} FROM onboarding_funnel WINDOW w AS (ORDER BY step_number)""",
    "metric_funnel_in_window": f"""
        SELECT signup_week, CAST(step_number AS INTEGER) AS step_number, step, accounts, {_SHARE_STEPS}
        FROM (SELECT signup_week, unnest(range(1, 6)) AS step_number,
                     unnest(['Signup', 'Workspace created', 'Project created', 'Teammate invited',
                             'Task completed']) AS step,
                     unnest([count(DISTINCT s.account_id),
                             count(DISTINCT s.account_id) FILTER (event_name = 'workspace_created'),
                             count(DISTINCT s.account_id) FILTER (event_name = 'project_created'),
                             count(DISTINCT s.account_id) FILTER (event_name = 'membership_invited'),
                             count(DISTINCT s.account_id) FILTER (event_name = 'task_completed')]) AS accounts
              FROM (SELECT *, {_week('signup_at')} AS signup_week FROM o_signups) s
              LEFT JOIN stg_product_events e ON e.account_id = s.account_id AND event_name IN {_SIGNALS}
                    AND event_at BETWEEN signup_at AND signup_at + INTERVAL 7 DAY
              GROUP BY signup_week)
        WINDOW w AS (PARTITION BY signup_week ORDER BY step_number)""",
    "metric_retention_by_activation": """
        SELECT is_activated, cohort_week, week_offset, cohort_size, count(DISTINCT w.account_id) AS retained_accounts,
               round(count(DISTINCT w.account_id) / nullif(cohort_size, 0), 4) AS retention_rate
        FROM (SELECT is_activated, cohort_week, CAST(unnest(range(13)) AS INTEGER) AS week_offset,
                     count(DISTINCT account_id) AS cohort_size FROM o_cohorts GROUP BY is_activated, cohort_week) g
        JOIN o_cohorts m USING (is_activated, cohort_week)
        LEFT JOIN o_weekly w ON w.account_id = m.account_id AND w.activity_week = cohort_week + 7 * week_offset
        WHERE week_offset <= greatest(0, ((SELECT max(activity_week) FROM o_weekly) - cohort_week) // 7)
        GROUP BY is_activated, cohort_week, week_offset, cohort_size""",
    "metric_churn_by_plan": f"""
        SELECT {_month('ended_at')} AS month, plan_code, count(DISTINCT account_id) AS churned_accounts,
               count(*) AS canceled_periods
        FROM int_subscription_history WHERE status = 'canceled' AND ended_at IS NOT NULL GROUP BY 1, 2""",
    "metric_mrr_by_plan": f"""
        SELECT mrr_month, plan_code,
               {_money('seats * monthly_unit_amount', 'sum')} AS mrr,
               count(DISTINCT account_id) AS paying_accounts
        FROM o_live_months GROUP BY 1, 2""",
    "metric_mrr_by_usage_segment": f"""
        SELECT mrr_month, coalesce(engagement_segment, 'low') AS engagement_segment,
               {_money('mrr', 'sum')} AS mrr,
               {_money('expansion_mrr', 'sum')} AS expansion_mrr,
               count(DISTINCT m.account_id) AS paying_accounts
        FROM fct_account_mrr m LEFT JOIN metric_engagement_segment s ON s.account_id = m.account_id GROUP BY 1, 2""",
    "metric_expansion_reason": f"""
        SELECT {_month('effective_at')} AS month, if(price_id <> price_before, 'upgrade', 'seat_add') AS reason,
               count(*) AS changes,
               {_money('amount - amount_before', 'sum')} AS expansion_mrr
        FROM (SELECT *, lag(price_id) OVER w AS price_before, lag(amount) OVER w AS amount_before
              FROM (SELECT *, seats * monthly_unit_amount AS amount FROM int_subscription_history)
              WINDOW w AS (PARTITION BY customer_id ORDER BY effective_at, subscription_id))
        WHERE amount > amount_before GROUP BY 1, 2""",
    "metric_engagement_segment": "SELECT * FROM metric_engagement_segment",
    "metric_dau_by_country": """
        SELECT activity_date, country, count(DISTINCT user_id) AS dau
        FROM int_user_activity JOIN dim_accounts USING (account_id) GROUP BY ALL""",
    "dau_by_country_sketched": """
        SELECT activity_date, country, count(DISTINCT user_id) AS dau, true AS dau_within
        FROM int_user_activity JOIN dim_accounts USING (account_id) GROUP BY ALL""",
    "metric_adoption_by_size": f"""
        SELECT feature_code, week, u.company_size, accounts_using_feature, coalesce(n, 0) AS active_accounts,
               round(accounts_using_feature / nullif(n, 0), 4) AS adoption_rate
        FROM (SELECT feature_code, usage_week AS week, company_size, count(DISTINCT account_id) AS accounts_using_feature
              FROM int_feature_usage JOIN dim_accounts USING (account_id) GROUP BY ALL) u
        LEFT JOIN (SELECT activity_week, company_size, count(DISTINCT account_id) AS n
                   FROM o_weekly JOIN dim_accounts USING (account_id) GROUP BY ALL) a
          ON activity_week = week AND a.company_size IS NOT DISTINCT FROM u.company_size""",
    "metric_churn_true": f"""
        WITH months AS (
            SELECT CAST(unnest(generate_series({_month('min(effective_at)')}, {_month(AS_OF)}, INTERVAL 1 MONTH)) AS DATE)
                   AS month FROM int_subscription_history),
        periods AS (SELECT account_id, status, CAST(effective_at AS DATE) AS s, CAST(ended_at AS DATE) AS e
                    FROM int_subscription_history WHERE account_id IS NOT NULL),
        active AS (SELECT DISTINCT month, account_id FROM months JOIN periods
                   ON s <= month AND coalesce(e > month, true)),
        active_next AS (SELECT DISTINCT month, account_id FROM months JOIN periods
                        ON s <= month + INTERVAL 1 MONTH AND coalesce(e > month + INTERVAL 1 MONTH, true)),
        stopped AS (SELECT DISTINCT {_month('e')} AS month, account_id FROM periods
                    WHERE status = 'canceled' AND e IS NOT NULL)
        SELECT a.month, count(*) AS active_at_start,
               count(*) FILTER (c.account_id IS NOT NULL AND n.account_id IS NULL) AS churned_accounts,
               round(count(*) FILTER (c.account_id IS NOT NULL AND n.account_id IS NULL) / count(*), 4) AS churn_rate
        FROM active a
        LEFT JOIN active_next n ON n.month = a.month AND n.account_id = a.account_id
        LEFT JOIN stopped c ON c.month = a.month AND c.account_id = a.account_id
        GROUP BY a.month""",
    "late_events": """
        SELECT CAST(event_at AS DATE) AS day, count(*) AS events,
               count(*) FILTER (source_updated_at - event_at > INTERVAL 1 HOUR) AS late_events
        FROM stg_product_events GROUP BY 1""",

    # ingestion and streams
    "ingest_envelope": "SELECT * FROM bronze_product_events",
    "ingest_updated_since":
        "SELECT * FROM bronze_product_events WHERE source_updated_at >= TIMESTAMP '2023-12-01 00:00:00'",
    "ingest_event_range": "SELECT * FROM bronze_product_events WHERE CAST(event_at AS DATE) BETWEEN '2023-10-01' AND '2023-10-31'",
    "ingest_keyset_page": """
        SELECT * FROM bronze_product_events
        WHERE (source_updated_at, event_id, load_id) > (TIMESTAMP '2023-11-01 00:00:00', '', '')
        ORDER BY source_updated_at, event_id, load_id LIMIT 1000""",
    "ingest_append_watermark": "SELECT * FROM bronze_product_events",
    "ingest_merge_latest": "SELECT * FROM bronze_crm_companies",
    "ingest_schema_evolution": "SELECT * FROM bronze_billing_prices",
    "ingest_flatten_props": """
        SELECT event_id, event_name, distinct_id, account_id, event_at, source_updated_at, load_id, country, channel,
               workspace_id, project_id, task_id, integration_type, from_plan, to_plan
        FROM o_delivered""",
    "ingest_backfill": "SELECT * FROM int_user_activity",
    "ingest_backfill_models": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {_dims(name)}" for name in MODELS),
    "ingest_backfill_retention": "SELECT * FROM fct_retention",
    "ingest_backfill_adoption": "SELECT * FROM fct_feature_adoption",
    "ingest_run": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM bronze_{name}" for name in BRONZE),
    **{f"ingest_merge_{name}": f"SELECT * FROM bronze_{name}" for name in (
        "crm_deals", "billing_customers", "billing_prices", "billing_subscriptions", "billing_invoices")},
    "write_layer": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {_dims(name)}" for name in MODELS),
    "stream_bronze_events": "SELECT * FROM bronze_product_events",
    "stream_dedup_events": """
        SELECT * FROM bronze_product_events
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY source_updated_at, load_id) = 1""",
    "stream_upsert_entities": "SELECT * FROM bronze_crm_companies",
    "stream_daily_activity": "SELECT * FROM int_user_activity",

    # scalar rules
    "std_country": _spelling(
        "bronze_crm_companies", "country",
        "CASE left(upper(country), 1) WHEN 'U' THEN if(upper(country) IN ('UK', 'UNITED KINGDOM'), 'GB', 'US') "
        "WHEN 'C' THEN 'CA' WHEN 'G' THEN if(country = 'GB', 'GB', country) END"),
    "std_plan": _spelling("bronze_billing_prices", "plan", "if(plan = 'ENT', 'enterprise', lower(plan))"),
    "std_frequency": _spelling(
        "bronze_billing_prices", "billing_frequency",
        "if(lower(billing_frequency) IN ('year', 'annual'), 'annual', 'monthly')"),
    "date_year_of": _event_days("CAST(year(day) AS INTEGER)", "year"),
    "date_month_of": _event_days("CAST(month(day) AS INTEGER)", "month"),
    "date_trunc_to_month": _event_days(_month("day"), "month_start"),
    "week_start": _event_days(_week("day"), "week_start"),

    # more models and checks
    "scd2_companies": """
        SELECT company_id, account_ref, name, industry, company_size, country, lead_source, lifecycle_stage,
               source_updated_at AS valid_from,
               CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2024-01-15 00:00:00' END AS valid_to,
               c_custkey % 10 <> 0 AS is_current
        FROM o_companies_first
        UNION ALL
        SELECT company_id, account_ref, name, industry, company_size, country, lead_source, 'churned',
               TIMESTAMP '2024-01-15 00:00:00', NULL, true
        FROM o_companies_first WHERE c_custkey % 10 = 0""",
    "dim_features": """
        SELECT feature_code, feature_name, CAST(coalesce(n, 0) AS BIGINT) AS event_count
        FROM o_features
        LEFT JOIN (SELECT feature_code, sum(event_count) AS n FROM int_feature_usage GROUP BY ALL) USING (feature_code)""",
    "dq_unique": "SELECT event_id, count(*) AS n FROM bronze_product_events GROUP BY event_id HAVING count(*) > 1",
    "dq_not_null": "SELECT * FROM dim_accounts WHERE company_id IS NULL",
    "dq_accepted_range": "SELECT * FROM stg_billing_prices WHERE unit_amount NOT BETWEEN 5 AND 15",
    "dq_generic_staging": _generic(list(STAGING)),
    "dq_generic_core": _generic(list(CORE)),
    "dq_generic_marts": _generic(list(MARTS)),
    "dq_grains": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM (SELECT 1 FROM {name} "
        f"WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)} GROUP BY {', '.join(keys)} HAVING count(*) > 1)"
        for name, keys in _GRAINS.items()),
    "dq_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM ({sql})" for name, sql in DQ.items()),
}

_NAME = re.compile(r"\b(" + "|".join(sorted(VIEWS, key=len, reverse=True)) + r")\b")


def _with_views(sql: str) -> str:
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name not in needed:
                visit(VIEWS[name])
                needed[name] = None

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {views}\nSELECT * FROM ({sql})"


def oracle_queries() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in ANSWERS.items()}
