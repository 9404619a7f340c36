"""Shuffle sizes from the bytes a plan is going to scan.

The session's ``spark.sql.shuffle.partitions`` is a floor here; AQE joins small
partitions again, but it cannot split an ordinary shuffle that was planned too
coarsely. So the number is raised, never lowered, when the input is large.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

BYTES_PER_PARTITION = 256 << 20  # of files scanned, so compressed; sorts may spill

_SETTING = "spark.sql.shuffle.partitions"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def scanned_bytes(df: DataFrame) -> int:
    """Size of the files (or other leaves) under a plan, as far as the planner knows it.

    Leaves only: the planner's guess for a join above them is their product. Leaves
    of unknown size (a database table, a local list) do not count.
    """
    unknown = df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < unknown)


def wanted_partitions(spark: SparkSession, *frames: DataFrame) -> int:
    bytes_ = sum(scanned_bytes(df) for df in frames)
    from_size = -(-bytes_ // BYTES_PER_PARTITION)
    return max(from_size, int(spark.conf.get(_SETTING)))


def range_partitioned(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range partitions in ``order``, more of them than the setting for a large input."""
    wanted = wanted_partitions(df.sparkSession, df)
    if wanted > int(df.sparkSession.conf.get(_SETTING)):
        return df.repartitionByRange(wanted, *order)
    return df.repartitionByRange(*order)


@contextmanager
def sized_shuffles(spark: SparkSession, *frames: DataFrame) -> Iterator[None]:
    """For the actions inside: enough shuffle partitions for these inputs."""
    before = spark.conf.get(_SETTING)
    wanted = wanted_partitions(spark, *frames)
    if wanted <= int(before):
        yield
        return
    spark.conf.set(_SETTING, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For the actions inside: rows go to Python a few megabytes at a time, not ten thousand whole texts."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(4 << 20))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """For a table written inside: the files of its shuffles go when it is written, not at some later collection."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
