"""The models of the warehouse, from bronze to marts.

Without a ``root`` a ``Warehouse`` only composes plans: asking for a model gives
a DataFrame over the bronze tables and runs nothing. With a ``root`` each model
is written to its layer when it is first asked for, and read from there by
whatever needs it. That is the way to run reports at scale: events are
deduplicated once and not once per consumer, reports read small marts, and a
lost executor costs the work on the current table only.

A build writes to a folder of its own, ``<root>/build-<id>``, and names it in a
pointer file when all tables are there. Other jobs attach with
``Warehouse.open``, which only reads; they keep what they opened while the next
build goes on, and a build that fails leaves the last one in place.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from growthlake.functions.semantics import month_start
from growthlake.operators import core, dims, facts, staging
from growthlake.operators.quality import row_metrics, violations_measured
from growthlake.sources.layers import write_table

Model = Callable[["Warehouse"], DataFrame]

STAGING: dict[str, Model] = {
    "stg_product_events": lambda w: staging.stg_product_events(w["product_events"]),
    "stg_crm_companies": lambda w: staging.stg_crm_companies(w["crm_companies"]),
    "stg_crm_contacts": lambda w: staging.stg_crm_contacts(w["crm_contacts"]),
    "stg_crm_deals": lambda w: staging.stg_crm_deals(w["crm_deals"]),
    "stg_billing_customers": lambda w: staging.stg_billing_customers(w["billing_customers"]),
    "stg_billing_prices": lambda w: staging.stg_billing_prices(w["billing_prices"]),
    "stg_billing_subscriptions": lambda w: staging.stg_billing_subscriptions(w["billing_subscriptions"]),
    "stg_billing_invoices": lambda w: staging.stg_billing_invoices(w["billing_invoices"]),
}
CORE: dict[str, Model] = {
    "int_identity_mapping": lambda w: core.int_identity_mapping(
        w["stg_product_events"], w["stg_crm_companies"], w["stg_billing_customers"]),
    "int_user_activity": lambda w: core.int_user_activity(w["stg_product_events"]),
    "int_account_usage": lambda w: core.int_account_usage(w["int_user_activity"]),
    "int_feature_usage": lambda w: core.int_feature_usage(w["stg_product_events"]),
    "int_user_activation": lambda w: core.int_user_activation(w["stg_product_events"]),
    "int_subscription_history": lambda w: core.int_subscription_history(
        w["stg_billing_subscriptions"], w["stg_billing_prices"], w["stg_billing_customers"]),
}
MARTS: dict[str, Model] = {
    "dim_accounts": lambda w: dims.dim_accounts(
        w["int_identity_mapping"], w["stg_crm_companies"], w["int_subscription_history"]),
    "dim_dates": lambda w: dims.dim_dates(w["stg_product_events"]),
    "dim_features": lambda w: dims.dim_features(w.spark),
    "dim_plans": lambda w: dims.dim_plans(w["stg_billing_prices"]),
    "fct_product_events": lambda w: facts.fct_product_events(
        w["stg_product_events"], w["int_identity_mapping"], facts.heavy_accounts(w["product_events"])),
    "fct_user_activation": lambda w: facts.fct_user_activation(w["int_user_activation"]),
    "fct_user_daily_activity": lambda w: facts.fct_user_daily_activity(w["int_user_activity"]),
    "fct_user_journey": lambda w: facts.fct_user_journey(w["stg_product_events"]),
    "fct_feature_adoption": lambda w: facts.fct_feature_adoption(w["int_feature_usage"], w["int_user_activity"]),
    "fct_subscription_history": lambda w: facts.fct_subscription_history(w["int_subscription_history"]),
    "fct_account_mrr": lambda w: facts.fct_account_mrr(w["int_subscription_history"], w.as_of),
    "fct_paid_conversion": lambda w: facts.fct_paid_conversion(
        w["int_identity_mapping"], w["int_subscription_history"]),
    "fct_churn": lambda w: facts.fct_churn(w["int_subscription_history"]),
    "fct_retention": lambda w: facts.fct_retention(w["fct_user_activation"], w["int_active_weeks"]),
    "fct_usage_expansion": lambda w: facts.fct_usage_expansion(w["int_account_usage"], w["fct_account_mrr"]),
    "fct_paid_base_daily": lambda w: facts.fct_paid_base_daily(w["fct_subscription_history"]),
}
# tables that several models and reports are computed from
SHARED: dict[str, Model] = {"int_active_weeks": lambda w: core.int_active_weeks(w["int_user_activity"])}
LAYERS = {"staging": STAGING, "core": {**CORE, **SHARED}, "marts": MARTS}
MODELS: dict[str, Model] = {**STAGING, **CORE, **MARTS}
TABLES: dict[str, Model] = {**MODELS, **SHARED}

# the models of a wave need those of earlier waves only, so they can be written side by side
_LATE = ["int_account_usage", "fct_retention", "fct_usage_expansion", "fct_paid_base_daily"]
WAVES = [
    list(STAGING),
    [name for name in CORE if name not in _LATE],
    ["int_account_usage", *SHARED, *[name for name in MARTS if name not in _LATE]],
    _LATE[1:],
]

# tables that grow without bound are split by the month their queries filter on
MONTH_OF = {"stg_product_events": "event_at", "fct_product_events": "event_at"}


POINTER = "current-"


def _layer_of(name: str) -> str:
    return next(layer for layer, models in LAYERS.items() if name in models)


class CheckFailed(RuntimeError):
    """A finished build breaks a rule that must hold."""


class Warehouse:
    """``bronze`` gives the bronze table of a name; ``as_of`` stands in for today."""

    def __init__(
        self, spark: SparkSession, bronze: Callable[[str], DataFrame], as_of: str, root: str | None = None,
        composed: Collection[str] = (),
    ):
        """``composed`` names tables that are not written when first asked for, but only by ``keep`` or ``build``."""
        self.spark = spark
        self.as_of = as_of
        self._bronze = bronze
        self._root = root
        self._folder = f"{root}/build-{uuid.uuid4().hex}" if root is not None else None
        self._attached = False
        self._composed = set(composed)
        self._frames: dict[str, DataFrame] = {}
        # per table, what its row checks counted when it was written
        self.measured: dict[str, dict[str, int]] = {}

    @classmethod
    def open(cls, spark: SparkSession, root: str, bronze: Callable[[str], DataFrame] | None = None) -> Warehouse:
        """The last finished build, to read from; nothing is computed or written."""
        def missing(name: str) -> DataFrame:
            raise KeyError(f"{name} is no table of the warehouse")

        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
        pointers = sorted(n for n in names if n.startswith(POINTER))
        if not pointers:
            raise FileNotFoundError(f"no finished build under {root}")
        built = json.loads(spark.read.text(f"{root}/{pointers[-1]}").first().value)
        warehouse = cls(spark, bronze or missing, built["as_of"], root)
        warehouse._folder, warehouse._attached = f"{root}/{built['folder']}", True
        warehouse.measured = built.get("measured", {})
        return warehouse

    @classmethod
    def over(
        cls, spark: SparkSession, tables: dict[str, DataFrame], bronze: Callable[[str], DataFrame], as_of: str
    ) -> Warehouse:
        """A warehouse whose models are there already, wherever they are stored."""
        warehouse = cls(spark, bronze, as_of)
        warehouse._frames.update(tables)
        return warehouse

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in TABLES:
                frame = self._bronze(name)
            elif self._attached:
                frame = self.spark.read.parquet(f"{self._folder}/{_layer_of(name)}/{name}")
            else:
                frame = TABLES[name](self)
                if self._root is not None and name not in self._composed:
                    frame = self._stored(name, frame)
            self._frames[name] = frame
        return self._frames[name]

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        checks = row_metrics(name, self.as_of)
        if name not in MONTH_OF:
            return write_table(df, self._folder, _layer_of(name), name, metrics=checks, measured=self.measured)
        by_month = df.withColumn("event_month", month_start(MONTH_OF[name]))
        return write_table(by_month, self._folder, _layer_of(name), name, "event_month", checks, self.measured)

    def keep(self, *names: str) -> Warehouse:
        """From now on these tables are stored as well: worth it where several models read them."""
        for name in self._composed & set(names):
            self._composed.discard(name)
            self._frames.pop(name, None)
        return self

    def build(self, threads: int = 4, refuse: Collection[str] = ()) -> Warehouse:
        """Writes every model that is not there yet, a few at a time.

        A build in which a row or scenario check named in ``refuse`` has
        violations is not published: readers stay with the last one.
        """
        self.keep(*TABLES)
        with ThreadPoolExecutor(threads) as pool:
            for wave in WAVES:
                list(pool.map(self.__getitem__, wave))
        if self._root is not None and not self._attached:
            found = {n: k for table in self.measured for n, k in violations_measured(self, table).items()}
            if unknown := set(refuse) - found.keys():
                raise ValueError(f"not measured while writing: {sorted(unknown)}")
            if broken := {n: k for n, k in found.items() if n in refuse and k}:
                raise CheckFailed(f"not published, violations per check: {broken}")
            self._publish()
        return self

    def _publish(self) -> None:
        """Names the finished build; the pointer appears whole, by a rename, and the last one counts."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        store = path(self._root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        temporary = path(f"{self._root}/_{uuid.uuid4().hex}")
        out = store.create(temporary)
        built = {"folder": self._folder.rpartition("/")[2], "as_of": self.as_of, "measured": self.measured}
        out.write(json.dumps(built).encode())
        out.close()
        store.rename(temporary, path(f"{self._root}/{POINTER}{time.time_ns():020d}"))
