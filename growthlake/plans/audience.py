"""Daily and weekly users per any dimension, from sketches kept per day.

A sketch counts different users; sketches of groups and days can be united. So
one pass over the activity, by day and all dimensions at once, serves the
audience of every dimension and every trailing window, at a bounded error. The
exact ``reports.dau_wau`` needs the user-days again for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthlake.functions.semantics import ratio
from growthlake.plans.metrics import metric_dau_by_country
from growthlake.plans.reports import dau_wau
from growthlake.plans.warehouse import Warehouse

LG_BUCKETS = 14
# three standard errors of a HyperLogLog sketch of 2^14 buckets, as a share
ERROR = 3 * 1.04 / 2 ** (LG_BUCKETS / 2)
WINDOW = 7
DIMENSIONS = ["country", "industry", "company_size", "plan_code"]


def day_sketches(w: Warehouse) -> DataFrame:
    """Day x dimensions: a sketch of its users. Partial sketches are joined before and behind the shuffle."""
    accounts = w["dim_accounts"].select("account_id", *DIMENSIONS)
    active = w["fct_user_daily_activity"].select("account_id", "user_id", "activity_date")
    return active.join(accounts, "account_id", "left").groupBy("activity_date", *DIMENSIONS).agg(
        F.hll_sketch_agg("user_id", F.lit(LG_BUCKETS)).alias("users"))


def audience(sketches: DataFrame, by: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """Day (x dimensions ``by``): users of the day, of the ``window`` days up to it, and their ratio.

    A day's sketch is joined into each of the windows it lies in; that is one
    small row per day, group and window, whatever the number of users.
    """
    keys = list(by or [])
    days = sketches.groupBy("activity_date", *keys).agg(F.hll_union_agg("users").alias("users"))
    covered = days.select(
        *keys, "users", "activity_date", F.explode(F.sequence(F.lit(0), F.lit(window - 1))).alias("after"))
    united = covered.groupBy(F.date_add("activity_date", F.col("after")).alias("day"), *keys).agg(
        F.hll_union_agg("users").alias("week"),
        F.max(F.when(F.col("after") == 0, F.hll_sketch_estimate("users"))).alias("dau"))
    return united.where(F.col("dau").isNotNull()).select(
        F.col("day").alias("activity_date"), *keys, "dau", F.hll_sketch_estimate("week").alias("wau")).withColumn(
        "stickiness", F.round(ratio(F.col("dau"), F.col("wau")), 4))


def within_error(estimate: Column, exact: Column) -> Column:
    """Whether an estimate is as near as sketches promise; of few users they are exact."""
    return F.abs(estimate - exact) <= F.ceil(exact * ERROR)


def dau_wau_sketched(w: Warehouse, sketches: DataFrame) -> DataFrame:
    """Exact daily and weekly users, and whether the sketches' are within their bound."""
    exact = dau_wau(w).select("activity_date", "dau", "wau")
    sketched = audience(sketches).select("activity_date", F.col("dau").alias("_dau"), F.col("wau").alias("_wau"))
    return exact.join(sketched, "activity_date", "left").select(
        "activity_date", "dau", "wau", F.coalesce(within_error(F.col("_dau"), F.col("dau")), F.lit(False)).alias("dau_within"),
        F.coalesce(within_error(F.col("_wau"), F.col("wau")), F.lit(False)).alias("wau_within"))


def dau_by_country_sketched(w: Warehouse, sketches: DataFrame) -> DataFrame:
    """Daily users per country, exactly, and whether the sketches' number is within its bound; from the same sketches."""
    exact = metric_dau_by_country(w)
    sketched = audience(sketches, ["country"]).select(
        "activity_date", F.col("country").alias("_country"), F.col("dau").alias("_dau"))
    same = (exact["activity_date"] == sketched["activity_date"]) & F.col("country").eqNullSafe(F.col("_country"))
    return exact.join(sketched, same, "left").select(
        exact["activity_date"], "country", "dau",
        F.coalesce(within_error(F.col("_dau"), F.col("dau")), F.lit(False)).alias("dau_within"))
