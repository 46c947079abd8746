"""Neighbouring rows of a group that may be far too big for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_neighbour(
    df: DataFrame, keys: list[str], bucket: Column, order: list[str], values: list[str],
    name: str, following: bool = False,
) -> DataFrame:
    """Adds a struct ``name`` with the values of the previous (or following) row of the key.

    A plain lag over the key would sort a hot key in a single task. Here each
    (key, bucket) is sorted on its own; the last row of every bucket is then
    handed to the next bucket of the key, which needs one row per bucket only.
    The bucket must not decrease in the given order, and ``order`` must be unique within a key.
    """
    def sorting(cols: list[str]) -> list[Column]:
        return [F.desc(c) if following else F.asc(c) for c in cols]

    edge = F.min_by if following else F.max_by
    rows = df.withColumns({"_bucket": bucket, "_values": F.struct(*values), "_is_row": F.lit(1)})
    edges = rows.groupBy(*keys, "_bucket").agg(edge("_values", F.struct(*order)).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy(*sorting(["_bucket"]))
    # the edge of the bucket before goes into the bucket as a row of its own, ahead of the others
    carried = edges.select(*keys, "_bucket", F.lag("_edge").over(across).alias("_values"), F.lit(0).alias("_is_row"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_is_row", *sorting(order))
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.lag("_values").over(inside))
        .where(F.col("_is_row") == 1)
        .drop("_bucket", "_values", "_is_row")
    )
