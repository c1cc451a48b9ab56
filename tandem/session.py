"""Shared scratch space for tables that must be computed once.

Row numbers and expensive model output must not be recomputed by a second job, because a changed set
of executors may split the input differently. Such tables are written to the folder the cluster names
in ``spark.checkpoint.dir`` and read back, so they also survive the loss of any executor.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder for scratch tables: the cluster's checkpoint folder, or where it is unset one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def fixed_splits(spark: SparkSession) -> None:
    """Make files split alike in every job of the session, however many executors it has by then.

    Spark cuts small inputs by the number of cores that it sees when a job starts. That number is noted once; a
    value that the user has set stays.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python steps by ``BATCH_BYTES``, however long their rows are.

    Spark's own bound is 64 MB, which every task holds once in the JVM and once in Python. A value that the user has set
    stays.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet.

    All tables of one application lie in one folder, which can be dropped when the application is over; a
    ``scratch_scope`` drops those made inside it.
    """
    path = f"{shared_dir(spark)}/tandem-{spark.conf.get('spark.app.id', 'local')}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, all scratch tables made inside it; results must have been written or collected."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            release(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the stored table, with its lineage cut.

    The stored table has real size statistics, so a later join broadcasts it only when Spark sees
    that it lies under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Scratch tables of one job; ``release`` deletes all but the ones named."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """As ``stage``; a second table under a label replaces the first, which is deleted."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        old = self.paths.get(label)
        self.paths[label] = path
        if old:
            release(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, *keep: str) -> None:
        for label in [label for label in self.paths if label not in keep]:
            release(self.spark, self.paths.pop(label))
