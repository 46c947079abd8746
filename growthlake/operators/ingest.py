"""Incremental ingestion: watermarks, keyset pages, append, merge, evolving shapes."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthlake.functions.semantics import month_start

CURSOR = "source_updated_at"


def _ntz(value) -> Column:
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def updated_since(df: DataFrame, since) -> DataFrame:
    """Rows written at or after the watermark."""
    return df.where(F.col(CURSOR) >= _ntz(since))


# folder columns of event tables, and the folder a time falls in
_FOLDERS = {"event_date": F.to_date, "event_month": month_start}


def event_range(df: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with business time in [start, end); reads the folders of those days or months only."""
    folders = {c: folder for c, folder in _FOLDERS.items() if c in df.columns}
    if start is not None:
        df = df.where(F.col("event_at") >= _ntz(start))
        for column, folder in folders.items():
            df = df.where(F.col(column) >= folder(_ntz(start)))
    if end is not None:
        df = df.where(F.col("event_at") < _ntz(end))
        for column, folder in folders.items():
            df = df.where(F.col(column) <= folder(_ntz(end)))
    return df


def keyset_page(df: DataFrame, keys: list[str], after: tuple | None, size: int) -> DataFrame:
    """The next ``size`` rows in key order, after the given key values.

    The keys must be unique together: repeated deliveries share cursor and id,
    so pages over events need the load id as a third key.
    """
    if after is not None:
        values = [_ntz(v) if k == CURSOR else F.lit(v) for k, v in zip(keys, after)]
        beyond = F.lit(False)
        for key, value in reversed(list(zip(keys, values))):
            beyond = (F.col(key) > value) | ((F.col(key) == value) & beyond)
        # the plain bound on the first key is implied, and reaches the scan
        df = df.where(F.col(keys[0]) >= values[0]).where(beyond)
    return df.orderBy(*keys).limit(size)


def high_watermark(df: DataFrame) -> DataFrame:
    """One row: the cursor value the next incremental load starts from."""
    return df.agg(F.max(CURSOR).alias("watermark"))


def append_incremental(existing: DataFrame, incoming: DataFrame, watermark) -> DataFrame:
    """Incoming rows that are not loaded yet; repeated deliveries stay.

    Only rows exactly on the watermark, or without a cursor, can have been
    loaded before, so only those meet the existing table, and only its rows of
    that kind. They are compared as a whole and counted: of a row that came
    twice and is loaded once, one is new. The watermark may be a scalar
    subquery, as of ``high_watermark(df).scalar()``, or none if no row had one.
    """
    at = F.col(CURSOR)
    if watermark is None:
        newer, on_edge = at.isNotNull(), at.isNull()
    else:
        newer, on_edge = at > _ntz(watermark), (at == _ntz(watermark)) | at.isNull()
    columns = [c for c in incoming.columns if c in existing.columns]
    rest = rows_beyond(incoming.where(on_edge), existing.where(on_edge), columns)
    return incoming.where(newer).unionByName(rest)


def rows_beyond(incoming: DataFrame, existing: DataFrame, columns: list[str]) -> DataFrame:
    """Incoming rows with as many equal ones, by these columns, as exceed those that exist."""
    def numbered(df: DataFrame) -> DataFrame:
        content = df.withColumn("_content", F.to_json(F.struct(*columns)))
        return content.withColumn("_copy", F.row_number().over(Window.partitionBy("_content").orderBy("_content")))

    keys = ["_content", "_copy"]
    return numbered(incoming).join(numbered(existing).select(*keys), keys, "left_anti").drop(*keys)


def union_evolved(frames: list[DataFrame]) -> DataFrame:
    """All rows of differently shaped loads; columns a load lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark cuts each task's rows to one per key before the shuffle
    (WindowGroupLimit), so a key with very many copies costs no more than others.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def delivery_content() -> Column:
    """Tells deliveries of an event apart that share cursor and load."""
    return F.xxhash64("account_id", "distinct_id", "event_name", "event_at", "properties")


def delivery_order(content: Column | None = None) -> list[Column]:
    """The order in which the first delivery of an event is the one that counts, in batches and streams alike."""
    return [F.asc(CURSOR), F.asc("load_id"), delivery_content() if content is None else content]


def merge_latest(loads: list[DataFrame], key: str) -> DataFrame:
    """Current row per key over all loads: the newest write, of the later load on a tie."""
    numbered = union_evolved([df.withColumn("_load", F.lit(i)) for i, df in enumerate(loads)])
    content = [c for c in numbered.columns if c != "_load"]
    order = [F.desc(CURSOR), F.desc("_load"), F.xxhash64(*content)]
    return first_per_key(numbered, [key], order).drop("_load")


def backfill(existing: DataFrame, source: DataFrame, since) -> DataFrame:
    """The table after its rows from the watermark on have been read again. Running it twice changes nothing."""
    kept = existing.where(F.col(CURSOR) < _ntz(since))
    return union_evolved([kept, updated_since(source, since)])
