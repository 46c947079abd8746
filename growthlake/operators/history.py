"""Versions of mutable records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthlake.operators.adjacent import with_neighbour
from growthlake.operators.ingest import CURSOR, first_per_key, union_evolved


def record_versions(loads: list[DataFrame], key: str) -> DataFrame:
    """Every version of a record with the time it was valid (type-2 history)."""
    numbered = union_evolved([df.withColumn("_load", F.lit(i)) for i, df in enumerate(loads)])
    content = [c for c in numbered.columns if c not in ("_load", CURSOR)]
    versions = first_per_key(numbered, [key, CURSOR], [F.desc("_load"), F.xxhash64(*content)]).drop("_load")
    followed = with_neighbour(
        versions, [key], F.date_trunc("hour", CURSOR), [CURSOR], [CURSOR], name="next_version", following=True)
    return followed.select(
        *content,
        F.col(CURSOR).alias("valid_from"),
        F.col(f"next_version.{CURSOR}").alias("valid_to"),
        F.col("next_version").isNull().alias("is_current"),
    )
