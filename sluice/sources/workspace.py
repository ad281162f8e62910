"""Shared folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

A session without that setting uses a folder in its warehouse, which all of a cluster's machines share as well.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"
#: Shuffle files go when the query that wrote them ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
#: Writes under way in a session, and its setting before the first of them.
_writes: dict = {}


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    return root.rstrip("/") if root else spark.conf.get(WAREHOUSE).rstrip("/") + "/_shared"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_root(spark)}/{label}-{uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession, label: str):
    """A new folder for tables that are read up before the block ends, which removes them."""
    path = new_folder(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Within the block, queries of the session remove their shuffle files when they end. For queries that run once only."""
    with _lock:
        count, before = _writes.get(spark) or (0, spark.conf.get(CLEANUP, None))
        _writes[spark] = (count + 1, before)
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            count, before = _writes.pop(spark)
            if count > 1:
                _writes[spark] = (count - 1, before)
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write rows once and read them back, so that later passes see the same rows and lineage is cut.

    What the write shuffled is removed from disk at its end: steps that follow each other don't add up there.
    """
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``write_table`` in a new folder, for lazy results; ``remove`` takes the folder away when they are read up."""
    return write_table(df, new_folder(df.sparkSession, label))
