"""Tables whose loads appear whole or not at all.

Data goes into folders that are never changed. A commit is a small file that
names the folders that make up the table, per bucket, and the cursor the next
load starts from; it appears by a rename that fails if its number is taken. So
a job that dies leaves the last commit as it was and at most a folder nobody
names, readers keep what they opened, and of two loads at once one is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
ALL = ""  # the bucket of a table that has none
EVENT_MONTH = "event_in_month"  # folder column of event loads, as yyyy-MM


class CommitConflict(RuntimeError):
    """Another load has committed since this one began; it can be run again."""


@dataclass(frozen=True)
class Commit:
    """``folders`` are relative to the table, by bucket (``ALL`` where it has none)."""

    version: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    cursor: str | None = None
    buckets: int = 0

    def all_folders(self) -> list[str]:
        return sorted({f for folders in self.folders.values() for f in folders})


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names_in(spark: SparkSession, path: str) -> list[str]:
    store, folder = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(folder)) if store.exists(folder) else []


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names_in(spark, f"{path}/{COMMITS}") if n.endswith(".json")]


def _commit_file(version: int) -> str:
    return f"{version:012d}.json"


def latest(spark: SparkSession, path: str) -> Commit | None:
    """The last commit, or none where the table does not exist yet."""
    versions = _versions(spark, path)
    return commit_of(spark, path, int(versions[-1].split(".")[0])) if versions else None


def commit_of(spark: SparkSession, path: str, version: int) -> Commit:
    text = spark.read.text(f"{path}/{COMMITS}/{_commit_file(version)}", wholetext=True).first().value
    return Commit(**json.loads(text))


def new_data_folder() -> str:
    return f"data/{uuid.uuid4().hex}"


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the rename happened; it does not where the target is there already."""
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    source_path, target_path = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    store, _ = _hadoop(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source_path, target_path, none)
    except Exception as refused:
        if "FileAlreadyExistsException" in str(refused):
            return False
        raise
    return True


def publish(spark: SparkSession, path: str, commit: Commit) -> None:
    """Makes the commit the last one, if its number is still free."""
    store, temporary = _hadoop(spark, f"{path}/{COMMITS}/_{uuid.uuid4().hex}")
    out = store.create(temporary)
    out.write(json.dumps(asdict(commit)).encode())
    out.close()
    if not rename_new(spark, temporary.toString(), f"{path}/{COMMITS}/{_commit_file(commit.version)}"):
        store.delete(temporary, False)
        raise CommitConflict(f"version {commit.version} of {path} is taken")


def read_folders(spark: SparkSession, path: str, folders: list[str], schema: str | None = None) -> DataFrame:
    """The rows of some folders; without a schema, all columns that any file has."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    if not folders:
        return spark.createDataFrame([], schema)
    return reader.parquet(*(f"{path}/{f}" for f in folders))


def read(spark: SparkSession, path: str, schema: str, version: int | None = None) -> DataFrame:
    """The table as of its last commit, or of an earlier one; a table without commits is a plain folder."""
    commit = latest(spark, path) if version is None else commit_of(spark, path, version)
    if commit is None:
        return spark.read.schema(schema).parquet(path)
    return read_folders(spark, path, commit.all_folders(), schema)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Removes commits before the last ``keep``, and the data folders that no other commit names.

    Not to be run while a load is on: its folder is not named yet.
    """
    versions = _versions(spark, path)
    gone, kept = versions[:-keep] if keep else versions, versions[-keep:] if keep else []
    named = {f for v in kept for f in commit_of(spark, path, int(v.split(".")[0])).all_folders()}
    removed = []

    def prune(folder: str) -> None:
        if folder in named:
            return
        if any(f.startswith(f"{folder}/") for f in named):
            for inner in names_in(spark, f"{path}/{folder}"):
                prune(f"{folder}/{inner}")
        elif not folder.endswith("_SUCCESS"):
            removed.append(folder)

    for load in names_in(spark, f"{path}/data"):
        prune(f"data/{load}")
    for victim in [*removed, *(f"{COMMITS}/{v}" for v in gone)]:
        store, target = _hadoop(spark, f"{path}/{victim}")
        store.delete(target, True)
    return removed
