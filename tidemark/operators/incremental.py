"""Incremental extract: rows strictly past a stored high watermark.

The comparison is made on the cursor column's own type, never on its text
(as text, ``'9' > '10'``), and on the bare column, so the scan can push it down.
Rows that later arrive with a cursor *equal* to the stored watermark are not
read again, unless the rows read there are remembered (``tied_rows``, ``late_rows``);
rows with a NULL cursor are read only when there is no lower bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.canonical import to_text, typed_literal
from tidemark.functions.names import ref, resolve


def lower_bound(resume: object | None, initial: object | None) -> str | None:
    """The stored watermark if there is one, else the configured start, else none."""
    chosen = resume if resume is not None else initial
    return None if chosen is None else str(chosen)


def read_past(
    df: DataFrame,
    cursor: str,
    resume: object | None = None,
    initial: object | None = None,
    upto: str | None = None,
) -> DataFrame:
    """Rows with ``cursor > bound``, and ``cursor <= upto`` where a ceiling is frozen."""
    name = resolve(df.columns, cursor)
    kind = df.schema[name].dataType
    column = F.col(ref(name))
    low = lower_bound(resume, initial)
    if low is not None:
        df = df.where(column > typed_literal(low, kind, name))
    if upto is not None:
        under = column <= typed_literal(upto, kind, name)
        df = df.where(under if low is not None else under | column.isNull())
    return df


def watermark_of(df: DataFrame, cursor: str) -> Column:
    """Aggregate: the highest cursor value as text. NULLs, NaNs and bytes never move it."""
    name = resolve(df.columns, cursor)
    kind = df.schema[name].dataType
    if isinstance(kind, T.BinaryType):
        return F.max(F.lit(None).cast("string"))
    value = F.col(ref(name))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)  # NaN sorts above all, and would end every later run
    return to_text(F.max(value), kind, name)


def high_watermark(df: DataFrame, cursor: str) -> DataFrame:
    return df.agg(watermark_of(df, cursor).alias("watermark"))


@dataclass(frozen=True)
class Frontier:
    """What a run is going to read: its frozen ceiling and the rows under it."""

    watermark: str | None
    rows: int


def frontier(
    df: DataFrame, cursor: str, resume: object | None = None, initial: object | None = None
) -> Frontier:
    """Freeze the ceiling before reading, in one pass over the cursor column."""
    past = read_past(df, cursor, resume, initial)
    row = past.agg(watermark_of(past, cursor).alias("watermark"), F.count("*").alias("n")).first()
    return Frontier(row["watermark"], row["n"])


def _at(df: DataFrame, cursor: str, watermark: str) -> DataFrame:
    name = resolve(df.columns, cursor)
    return df.where(F.col(ref(name)) == typed_literal(watermark, df.schema[name].dataType, name))


def _hashes(df: DataFrame) -> list[Column]:
    marked = [part for c in df.columns for part in (F.col(ref(c)), F.col(ref(c)).isNull())]
    return [
        F.xxhash64(*marked).alias("tm_hash_a"),
        F.xxhash64(F.lit("again"), *reversed(marked)).alias("tm_hash_b"),
    ]


def tied_rows(df: DataFrame, cursor: str, watermark: str) -> DataFrame:
    """What tells the rows at the watermark: two hashes, and how many rows have them."""
    at = _at(df, cursor, watermark).select(*_hashes(df))
    return at.groupBy("tm_hash_a", "tm_hash_b").agg(F.count("*").alias("copies"))


def late_rows(df: DataFrame, cursor: str, watermark: str, seen: DataFrame) -> DataFrame:
    """Rows at the watermark that are not among those ``seen`` there, as a multiset.

    Equal rows are counted before anything is joined, so a row that is there a million
    times is one; only rows of this one cursor value are read.
    """
    own = [ref(c) for c in df.columns]
    counted = _at(df, cursor, watermark).groupBy(own).agg(F.count("*").alias("tm_rows"))
    hashed = counted.select(*own, "tm_rows", *_hashes(df))
    late = F.col("tm_rows") - F.coalesce(F.col("copies"), F.lit(0))
    return (
        hashed.join(seen, ["tm_hash_a", "tm_hash_b"], "left")
        .withColumn("tm_late", late)
        .where("tm_late > 0")
        .select(*own, F.explode(F.sequence(F.lit(1).cast("long"), "tm_late")).alias("tm_nth"))
        .select(own)
    )
