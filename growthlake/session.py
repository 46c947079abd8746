"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. The skew settings let AQE split the
# shuffle partitions of a hot account or customer even where an aggregation
# follows the join (that costs one more exchange, only when there is skew).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


PARTITION_BYTES = 16 << 20
READ_BYTES = 8 << 20


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Applies the settings. ``input_bytes`` sizes the shuffles: AQE merges small partitions but never adds any,
    so a job over very much data should start with one per ``PARTITION_BYTES`` of it.

    Such a job also reads ``READ_BYTES`` a task, however large its files: what a task sorts or counts before a
    shuffle then stays the same size, and is not spilled, where Spark would give it more of a larger table. Behind a
    shuffle, too, rows take several times their size there, so AQE merges half as much as it would."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(2 * PARTITION_BYTES))
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(READ_BYTES))
    return spark


def local_session(cores: int | str = "*", app: str = "growthlake", memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    partitions = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    return tune(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="growthlake-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/growthlake/{name}-{uuid.uuid4().hex}"
