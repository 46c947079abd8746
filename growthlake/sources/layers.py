"""Tables of the warehouse layers, as Parquet folders ``<root>/<layer>/<name>``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from growthlake.sources import committed
from growthlake.sources.schemas import BRONZE


def write_table(
    df: DataFrame, root: str, layer: str, name: str, partition_by: str | None = None,
    metrics: Mapping[str, Column] | None = None, measured: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Replaces the table and returns it as read back, so later work starts from the files.

    In a table with folders, the rebalance hint lets AQE size the files: a hot
    day or month is split over several tasks. Others are written by the tasks
    that compute them, with no shuffle for it. ``metrics`` are aggregates taken
    from the rows as they are written, into ``measured`` under the table's name:
    by the writing tasks, so that a task that runs again counts once.
    """
    path, seen = f"{root}/{layer}/{name}", Observation()
    rows = df.hint("rebalance", partition_by) if partition_by else df
    if metrics:
        rows = rows.observe(seen, *(value.alias(label) for label, value in metrics.items()))
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if metrics:
        measured[name] = {label: value or 0 for label, value in seen.get.items()}
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_bronze(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight bronze tables, as of their last commit; a column a file lacks reads as null."""
    return {name: committed.read(spark, f"{root}/bronze/{name}", ddl) for name, ddl in BRONZE.items()}


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Makes tables available to ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
