"""Intermediate tables in the folder that driver and executors share.

Iterative operators cut their lineage by writing Parquet below
``spark.checkpoint.dir`` and reading it back. The files outlive any executor,
so a lost one costs only the tasks that were running on it.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; below the warehouse where that is unset (as in tests)."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        set_dir = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
        spark.conf.set("spark.checkpoint.dir", set_dir)
    return set_dir.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Whether shuffle files go as soon as the query that wrote them has ended, rather than with the driver's garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of what was written.

    The written table replaces all that led to it, so its shuffle files are dropped at once.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _staged.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


class _Staged(threading.local):
    """Folders that a thread has staged and not deleted, oldest first: queries that run side by side don't see each other's."""

    def __init__(self):
        self.paths: list[str] = []


_staged = _Staged()


def mark() -> int:
    """A point in time for :func:`release`, in the thread that calls both."""
    return len(_staged.paths)


def release(spark: SparkSession, since: int = 0, *keep: DataFrame) -> None:
    """Delete the folders that this thread staged since a mark, apart from those that ``keep`` reads: those of an operator that has ended, or,
    once its result is written, of a query."""
    kept = [file for df in keep for file in df.inputFiles()]
    for path in _staged.paths[since:]:
        name = path.rsplit("/", 1)[1]
        if not any(f"/{name}/" in file for file in kept):
            _delete(spark, path)
            _staged.paths.remove(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files behind staged frames that no plan needs any more."""
    for df in frames:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()[:1]}:
            _delete(df.sparkSession, folder)
            _staged.paths[:] = [path for path in _staged.paths if path.rsplit("/", 1)[1] != folder.rsplit("/", 1)[1]]
