"""Shared scratch space for intermediate tables.

Intermediate results that several jobs read (ranged rows awaiting ids, parsed CSV awaiting its
bad-row check) are written as Parquet to the folder the cluster names in
``spark.checkpoint.dir``. A written table survives the loss of any executor, cuts the lineage,
and keeps column pruning, which an RDD checkpoint would not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: Whether the files that a query has shuffled go at its end; by default they stay until the driver
#: happens to collect its garbage.
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach; a local one only for a local-mode session."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="skyledger-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never one that exists already."""
    return f"{shared_dir(spark)}/skyledger/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold in here."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries begun in here remove what they shuffled when they end. Meant for writes: a result
    that is computed a second time from the same object would be shuffled again."""
    return settings(spark, {CLEANUP_SETTING: "true"})


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return a reader over the written table."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def matching_paths(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, length) of the files and directories that a pattern matches, in order."""
    fs, hadoop_path = _file_system(spark, pattern)
    found = fs.globStatus(hadoop_path) or []
    return sorted((status.getPath().toString(), fs.getContentSummary(status.getPath()).getLength())
                  for status in found)


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute form with scheme, so that two spellings of one folder compare equal."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it; nothing happens if it is there."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        fs.create(hadoop_path, True).close()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename; the folder above the target is made if need be."""
    fs, target_path = _file_system(spark, target)
    _, source_path = _file_system(spark, source)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def swap_directory(spark: SparkSession, staged: str, target: str) -> None:
    """Put ``staged`` in the place of ``target``; the old content goes only after the new is there."""
    folder, _, _ = target.rstrip("/").rpartition("/")
    # A name that readers skip, as it may stand among the directories of a table.
    retired = f"{folder}/_retired-{uuid.uuid4().hex}"
    replaces = path_exists(spark, target)
    if replaces:
        move_path(spark, target, retired)
    try:
        move_path(spark, staged, target)
    except OSError:
        if replaces:
            move_path(spark, retired, target)
        raise
    if replaces:
        delete_path(spark, retired)
