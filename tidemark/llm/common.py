"""Small helpers of the operators: tables, words, row keys, numbering."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.sources.query import read_table

#: White space between words, as a class of Java and Python patterns.
GAP = r"[\x20\x09-\x0D]+"

ROWS_PER_BUCKET = 5_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    return storage.materialize(df, purpose)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def text_key(text: Column) -> Column:
    """64 bits that stand for a text; null has its own."""
    return F.when(text.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(text))


def lowest(rows: DataFrame, at: str, of: int, size: int) -> DataFrame:
    """About twice ``size`` rows (all, if they are fewer): those of the lowest of ``of`` hashes ``at``.

    A sample by ORDER BY and LIMIT sends that many rows of every partition to the driver;
    taken from these rows, it sends no more than they are, whatever the size of the input.
    """
    bound = min((1 << 63) - 1, 2 * size * (1 << 64) // max(of, 1) - (1 << 63))
    return rows.where(F.col(at) <= F.lit(bound))


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(1, math.ceil(rows / rows_per_bucket))


def running(
    df: DataFrame, group: str, weight: str, order: list[str], out: str, buckets: int
) -> DataFrame:
    """``df`` with, in ``out``, the sum of ``weight`` over the rows before it in its group.

    A group is cut by a hash of ``order`` into buckets, so that one that holds a third of
    all rows is summed by many tasks: sums by (group, bucket) first, their running total
    over the few buckets of a group next, and a window within each bucket last. The order
    within a group is therefore (bucket, ``order``). Groups may be null.
    """
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    rows = df.withColumn("__bucket", bucket)
    sums = rows.groupBy(group, "__bucket").agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("__group"),
        F.col("__bucket").alias("__at"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"),
    )
    inside = (
        Window.partitionBy(group, "__bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = rows.join(
        starts,
        rows[group].eqNullSafe(starts["__group"]) & (rows["__bucket"] == starts["__at"]),
    )
    total = F.col("__start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return joined.withColumn(out, total).drop("__bucket", "__group", "__at", "__start")
