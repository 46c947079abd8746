"""Bronze tables derived from the TPC-H-like driver tables.

The driver's tables know nothing of subscriptions, so each of their rows is read
as a business record: an event as a product event, a customer as a CRM company
and a billing customer, an order as a subscription period and a deal, a part as
a price, the line items of an order as its invoice. Every row takes part.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlake.operators.ingest import merge_latest, union_evolved

# the date the driver data is looked at from
AS_OF = "2024-02-01"


# schemas of the driver tables; given to the reader, so that it opens no file to find out
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=4)
def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of the tables' files."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet") for name in SCHEMAS]
    stores = [(path.getFileSystem(spark._jsc.hadoopConfiguration()), path) for path in paths]
    return sum(store.getContentSummary(path).getLength() for store, path in stores if store.exists(path))


def _pick(index: str, values: list[str]) -> str:
    """SQL for the value at a position counted from zero."""
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast({index} + 1 AS int))"


def _days_after(start: str, days: str) -> str:
    return f"timestamp_ntz'{start}' + make_dt_interval(cast({days} AS int))"


# accounts of very different sizes: shared ones, ones with three and ones with ten projects of a user
_ACCOUNT = """CASE user_id % 5 WHEN 0 THEN user_id * 10 + event_id % 10
              WHEN 1 THEN user_id * 10 + event_id % 3 ELSE (user_id - user_id % 2) * 10 END"""

_EVENT_NAME = f"""CASE event_type
    WHEN 'signup' THEN {_pick('k % 4', ['account_created', 'user_signup', 'membership_invited', 'plan_changed'])}
    WHEN 'view' THEN if(k % 2 = 0, 'workspace_created', 'task_commented')
    WHEN 'click' THEN if(k % 2 = 0, 'project_created', 'task_created')
    WHEN 'purchase' THEN if(k % 3 = 0, 'integration_connected', 'task_completed')
    ELSE 'task_assigned' END"""

# property -> events that carry it, and its value
_PROPERTIES = {
    "country": ("user_signup account_created", _pick("k % 3", ["US", "CA", "GB"])),
    "channel": ("user_signup account_created", _pick("k % 3", ["organic", "paid", "referral"])),
    "workspace_id": ("workspace_created project_created task_created", "'ws_' || k"),
    "project_id": ("project_created task_created task_completed", "'prj_' || k"),
    "task_id": ("task_created task_assigned task_commented task_completed", "'tsk_' || k"),
    "integration_type": ("integration_connected", _pick("k % 2", ["slack", "github"])),
    "from_plan": ("plan_changed", _pick("k % 3", ["free", "trial", "pro"])),
    "to_plan": ("plan_changed", _pick("k % 3", ["trial", "pro", "enterprise"])),
}
_PROPERTIES_JSON = "to_json(named_struct('k', k, " + ", ".join(
    f"'{name}', CASE WHEN event_name IN ({', '.join(repr(e) for e in events.split())}) THEN {value} END"
    for name, (events, value) in _PROPERTIES.items()
) + "))"

# a late event takes three days to arrive, others a minute; some arrive a second time
_DELIVERIES = """filter(array(
    named_struct('source_updated_at', event_at + if(n % 16 = 0, interval 3 days, interval '0 00:01:00' day to second),
                 'load_id', '0'),
    if(n % 25 = 0, named_struct('source_updated_at', event_at + interval 4 days, 'load_id', '1'), null)
  ), delivery -> delivery IS NOT NULL)"""


def events_from(raw: DataFrame) -> DataFrame:
    """Product events of a batch or a stream of driver events, some of them delivered twice.

    The 30 days of the driver are stretched to 120 so that cohorts and months
    have something to show.
    """
    event = ["event_id", "event_name", "distinct_id", "account_id", "event_at"]
    return (
        raw.selectExpr("*", "cast(get_json_object(props, '$.k') AS bigint) AS k")
        .selectExpr(
            "event_id AS n",
            "'evt_' || event_id AS event_id",
            f"{_EVENT_NAME} AS event_name",
            "'usr_' || user_id AS distinct_id",
            f"'acc_' || {_ACCOUNT} AS account_id",
            "timestamp_ntz'2023-09-15 00:00:00' + (ts - timestamp_ntz'2024-01-01 00:00:00') * 4 AS event_at",
            "k",
        )
        .selectExpr(*event, f"{_PROPERTIES_JSON} AS properties", f"inline({_DELIVERIES})")
        .select(*event, "source_updated_at", "properties", "load_id")
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from(table(spark, sf_dir, "events"))


_STAGE = _pick("c_custkey % 6", ["subscriber", "lead", "mql", "sql", "customer", "churned"])


def company_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """First load and a later one in which some companies have churned."""
    spellings = ["US", "USA", "United States", "CA", "Canada", "CAN", "GB", "UK", "United Kingdom"]
    country = f"if(c_nationkey = 24, 'Germany', {_pick('c_nationkey % 3 * 3 + c_custkey % 3', spellings)})"
    size = """CASE WHEN c_acctbal < 1000 THEN '1-10' WHEN c_acctbal < 3000 THEN '11-50'
              WHEN c_acctbal < 5000 THEN '51-200' WHEN c_acctbal < 8000 THEN '201-1000' ELSE '1000+' END"""
    source = _pick("c_custkey % 5", ["organic", "paid", "referral", "partner", "outbound"])

    def load(rows: DataFrame, stage: str, updated: str) -> DataFrame:
        return rows.selectExpr(
            "'cmp_' || c_custkey AS company_id",
            "if(c_custkey % 19 = 0, null, 'acc_' || c_custkey) AS account_ref",
            "c_name AS name", "c_mktsegment AS industry",
            f"{size} AS company_size", f"{country} AS country", f"{source} AS lead_source",
            f"{stage} AS lifecycle_stage", f"{updated} AS source_updated_at",
        )

    customers = table(spark, sf_dir, "customer")
    return [
        load(customers, _STAGE, _days_after("2023-09-01", "c_custkey % 90")),
        load(customers.where("c_custkey % 10 = 0"), "'churned'", "timestamp_ntz'2024-01-15'"),
    ]


def contact_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Contacts, some without a company; a later load links half of those."""
    def load(rows: DataFrame, company: str, updated: str) -> DataFrame:
        return rows.selectExpr(
            "'ctc_' || c_custkey AS contact_id", f"{company} AS company_id",
            "'user' || c_custkey || '@example.com' AS email",
            "if(c_custkey % 7 = 0, null, 'Contact') AS first_name", "c_name AS last_name",
            f"{_STAGE} AS lifecycle_stage", f"{updated} AS source_updated_at",
        )

    customers = table(spark, sf_dir, "customer")
    return [
        load(customers, "if(c_custkey % 9 = 0, null, 'cmp_' || c_custkey)",
             _days_after("2023-09-02", "c_custkey % 90")),
        load(customers.where("c_custkey % 18 = 0"), "'cmp_' || c_custkey", "timestamp_ntz'2024-01-16'"),
    ]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a start day inside a 140-day span."""
    return table(spark, sf_dir, "orders").selectExpr(
        "*", "cast(datediff(to_date(o_orderdate), date'1995-01-01') % 140 AS int) AS day")


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).selectExpr(
        "'deal_' || o_orderkey AS deal_id", "'cmp_' || o_custkey AS company_id",
        "CASE o_orderstatus WHEN 'F' THEN 'closed_won' WHEN 'O' THEN 'new' ELSE 'trial' END AS deal_stage",
        "o_totalprice AS amount",
        f"if(o_orderstatus = 'P', null, {_days_after('2023-10-01 12:00:00', 'day')}) AS close_date",
        f"{_days_after('2023-09-01 06:00:00', 'day')} AS source_updated_at",
    )


def billing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "'cus_' || c_custkey AS customer_id",
        "if(c_custkey % 17 = 0, null, 'acc_' || c_custkey) AS account_ref",
        "'billing' || c_custkey || '@example.com' AS email", "c_name AS name",
        f"{_days_after('2023-09-01', 'c_custkey % 60')} AS source_updated_at",
    )


def price_shapes(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Prices before and after ``plan_code`` came in; the older shape lacks the column."""
    spellings = [
        "Free", "FREE", "free", "Trial", "TRIAL", "trial", "Pro", "PRO", "pro",
        "Enterprise", "ENT", "enterprise", "Pro", "PRO", "pro",
    ]
    plan = f"if(p_partkey % 50 = 49, 'Legacy', {_pick('p_partkey % 5 * 3 + p_partkey % 3', spellings)})"
    codes = _pick("p_partkey % 5", ["free", "trial", "pro", "enterprise", "pro"])
    frequency = _pick("if(p_partkey % 5 = 4, 3, 0) + p_partkey % 3",
                      ["monthly", "Monthly", "month", "annual", "Annual", "year"])
    amount = "if(p_partkey % 5 < 2, 0.0D, cast(floor(p_retailprice) AS double) / 100)"

    def shape(rows: DataFrame, updated: str, *more: str) -> DataFrame:
        return rows.selectExpr(
            "'prc_' || p_partkey AS price_id", "p_brand AS product_id", f"{plan} AS plan", *more,
            f"{amount} AS unit_amount", "'usd' AS currency", f"{frequency} AS billing_frequency",
            f"timestamp_ntz'{updated}' AS source_updated_at",
        )

    parts = table(spark, sf_dir, "part")
    return [
        shape(parts.where("p_partkey % 2 = 0"), "2023-08-01"),
        shape(parts.where("p_partkey % 2 = 1"), "2023-09-30",
              f"if(p_partkey % 50 = 49, 'legacy', {codes}) AS plan_code"),
    ]


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One period per order; a customer's next start day ends it.

    The next day is looked up among the customer's distinct days (140 at most),
    so a customer with very many orders never becomes one task. It is an outer
    join of unique keys, which Spark leaves out where a query needs neither end
    nor status, as whether an account ever paid or its latest plan. The price is
    that of the order's first part (of a part numbered like the customer, if an
    order has no lines). Some live periods are known to end after ``AS_OF``.
    """
    first_part = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_partkey").alias("first_part"))
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "day")
    following = orders.select("o_custkey", "day").distinct().selectExpr(
        "*", "lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS next_day")
    status = """CASE WHEN next_day IS NOT NULL THEN if(o_orderkey % 7 = 0, 'canceled', 'superseded')
                     WHEN o_orderstatus = 'F' THEN 'canceled'
                     WHEN o_orderpriority LIKE '4%' THEN 'trialing'
                     WHEN o_orderpriority LIKE '5%' AND o_orderstatus = 'P' THEN 'past_due'
                     ELSE 'active' END"""
    start = ("timestamp_ntz'2023-09-01' + make_dt_interval("
             "day + if(o_orderkey % 97 = 0, 365, 0), cast(o_orderkey % 24 AS int))")
    end = f"""CASE WHEN next_day IS NOT NULL THEN {_days_after('2023-09-01', 'next_day')}
                   WHEN o_orderstatus = 'F' THEN {_days_after('2023-09-16', 'day')}
                   WHEN o_orderkey % 13 = 0 THEN timestamp_ntz'2024-06-01' END"""
    return (
        orders.join(following, ["o_custkey", "day"], "left").join(first_part, "o_orderkey", "left")
        .selectExpr("*", f"{status} AS status", f"{start} AS start_date", f"{end} AS ended_at")
        .selectExpr("*", "start_date - make_dt_interval(if(o_orderkey % 10 = 0, 2, 0)) AS recorded_at")
        .selectExpr(
            "'sub_' || o_orderkey AS subscription_id", "'cus_' || o_custkey AS customer_id",
            "'prc_' || coalesce(first_part, o_custkey) AS price_id", "status",
            "cast(o_orderkey % 10 + 1 AS int) AS seats", "start_date", "ended_at", "recorded_at",
            "start_date AS effective_at", "recorded_at + make_dt_interval(0, 1) AS source_updated_at",
        )
    )


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One invoice per order with line items; the amount is summed exactly."""
    net = "cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(4,2)))"
    amounts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.expr(f"cast(sum({net}) AS double)").alias("amount_due"))
    return _orders(spark, sf_dir).join(amounts, "o_orderkey").selectExpr(
        "'inv_' || o_orderkey AS invoice_id", "'cus_' || o_custkey AS customer_id",
        "'sub_' || o_orderkey AS subscription_id", "amount_due",
        "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'open' ELSE 'void' END AS status",
        f"{_days_after('2023-09-01', 'day')} AS created_at",
        f"{_days_after('2023-09-02', 'day')} AS source_updated_at",
    )


def crm_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_latest(contact_batches(spark, sf_dir), "contact_id")


def crm_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_latest(company_batches(spark, sf_dir), "company_id")


def billing_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_evolved(price_shapes(spark, sf_dir))


BRONZE = {
    "product_events": product_events,
    "crm_contacts": crm_contacts,
    "crm_companies": crm_companies,
    "crm_deals": deals,
    "billing_customers": billing_customers,
    "billing_prices": billing_prices,
    "billing_subscriptions": subscriptions,
    "billing_invoices": invoices,
}
