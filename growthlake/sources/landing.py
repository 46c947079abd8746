"""API pages landed as JSON files: ``{"data": [...], "next_cursor": ...}``, one page per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ISO timestamps, with or without microseconds
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_pages(spark: SparkSession, path: str, row_schema: str, multi_line: bool = False) -> DataFrame:
    """Rows of all landed pages, under the given schema."""
    row = T.StructType.fromDDL(row_schema)
    envelope = T.StructType().add("data", T.ArrayType(row)).add("next_cursor", T.StringType())
    reader = spark.read.schema(envelope).option("multiLine", multi_line)
    pages = reader.option("timestampNTZFormat", TIMESTAMP_FORMAT).json(path)
    return pages.select(F.inline("data"))


def write_pages(df: DataFrame, path: str, size: int = 100) -> None:
    """Lands rows as pages of at most ``size`` rows."""
    numbered = df.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_n"))
    pages = (
        numbered.groupBy(F.floor(F.col("_n") / size).alias("_page"))
        .agg(F.collect_list("row").alias("data"))
        .select("data", F.col("_page").cast("string").alias("next_cursor"))
    )
    pages.write.mode("errorifexists").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
