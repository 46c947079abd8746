"""Benchmark: the full warehouse build from raw tables, every report over the built marts, and models from raw.

BENCH_SF_DIR names the driver folder, BENCH_CPUS the number of local cores.
Prints one JSON line; the value is the sum over all parts. A part is run
BENCH_REPEATS times with fresh plans, and its median counts; the build runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from growthlake.plans.metrics import METRICS
from growthlake.plans.reports import REPORTS
from growthlake.registry import FUNCTIONS
from growthlake.session import local_session, new_folder, tune
from growthlake.sources import driver_tables
from growthlake.plans.warehouse import Warehouse

RAW_MODELS = [
    "stg_product_events", "int_user_activation", "int_user_activity", "int_subscription_history", "dim_accounts",
    "fct_user_journey", "fct_feature_adoption", "fct_retention", "fct_account_mrr", "fct_churn",
    "fct_usage_expansion", "fct_paid_base_daily",
]
INGEST = ["ingest_append_watermark", "ingest_merge_latest", "stream_dedup_events", "stream_daily_activity"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, app="growthlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)

    def median(action) -> float:
        return round(statistics.median(timed(action) for _ in range(repeats)), 3)

    def fresh(root: str | None = None) -> Warehouse:
        return Warehouse(spark, lambda name: driver_tables.BRONZE[name](spark, sf_dir), driver_tables.AS_OF, root)

    seconds: dict[str, float] = {}
    stored = fresh(new_folder(spark, "bench"))
    seconds["build_warehouse"] = round(timed(stored.build), 3)
    for name, plan in {**REPORTS, **METRICS}.items():
        seconds[name] = median(lambda: run(plan(stored)))
    for name in RAW_MODELS:
        seconds[f"raw_{name}"] = median(lambda: run(fresh()[name]))
    queries = {f.__name__: f for f in FUNCTIONS}
    for name in INGEST:
        seconds[name] = median(lambda: run(queries[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "total seconds: warehouse build, reports on marts, models from raw tables, ingestion",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus, "repeats": repeats,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
