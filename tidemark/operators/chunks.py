"""Chunks of a result in cursor order, without sorting it in one task.

Both operators are a two-pass prefix sum: lay rows out in cursor ranges, total
each range, shift every row by the ranges before it. The totals are one number
per shuffle partition, so they are the only thing that passes the driver.
"""

from __future__ import annotations

from itertools import accumulate
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.canonical import to_text, typed_literal
from tidemark.functions.names import ref, resolve
from tidemark.sizing import range_partitioned, wanted_partitions
from tidemark.storage import materialize

CHUNKS_PER_BLOCK = 10_000
VALUES_PER_RANGE = 32
TIE, PART, AT, BEFORE = "tm_tie", "tm_part", "tm_at", "tm_before"
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def range_starts(df: DataFrame, cursor: str, ranges: int) -> list[str]:
    """Canonical texts of the values at which ``ranges`` ranges of the cursor's values begin.

    From a sketch of bounded size: different values are dealt into buckets by their hash,
    and each bucket gives the one of least hash. One pass over the cursor, one row a bucket.
    """
    kind, value = df.schema[cursor].dataType, F.col(ref(cursor))
    bucket = F.pmod(F.xxhash64(value), F.lit(ranges * VALUES_PER_RANGE))
    sketch = (
        df.where(value.isNotNull())
        .groupBy(bucket)
        .agg(F.min_by(value, F.xxhash64(F.lit("again"), value)).alias("value"))
        .orderBy("value")
    )
    texts = [r["text"] for r in sketch.select(to_text(F.col("value"), kind, cursor).alias("text")).collect()]
    starts = [texts[len(texts) * i // ranges] for i in range(1, ranges) if texts]
    return [text for text, before in zip(starts, [None, *starts]) if text != before]


def range_number(value: Column, starts: list[Column]) -> Column:
    """The number of the range that holds a value; NULLs have the one after the last.

    Looked up in two steps, among about the square root of the starts each.
    """
    last = F.lit(len(starts) + 1)
    if not starts:
        return F.when(value.isNull(), last).otherwise(F.lit(0))
    width = isqrt(len(starts) - 1) + 1
    groups = [starts[i : i + width] for i in range(0, len(starts), width)]
    group = F.size(F.filter(F.array(*[g[0] for g in groups]), lambda start: start <= value))
    inside = F.get(F.array(*[F.array(*g) for g in groups]), group - 1)
    within = F.size(F.filter(inside, lambda start: start <= value))
    number = F.when(group == 0, F.lit(0)).otherwise((group - 1) * width + within)
    return F.when(value.isNull(), last).otherwise(number)


def _with_offsets(placed: DataFrame, totals: list[tuple[int, int]]) -> DataFrame:
    """Add the number of rows in all earlier ranges."""
    totals = sorted(totals)
    starts = accumulate((n for _, n in totals), initial=0)
    offsets = placed.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(totals, starts)], f"{PART} int, {BEFORE} long"
    )
    # One row per shuffle partition, so the broadcast does not grow with the data.
    return placed.join(F.broadcast(offsets), PART)


def _counted_in_ranges(df: DataFrame, name: str, starts: list[Column]) -> DataFrame:
    """Every cursor value with its rows, the number of its range, and the rows of the range
    up to it. The range is a column, so the window needs no exchange besides that of the
    ranges, and values of one range stay in one task only while they are counted."""
    value = F.col("value")
    counted = df.groupBy(F.col(ref(name)).alias("value")).agg(F.count("*").alias("n"))
    ranged = counted.withColumn(PART, range_number(value, starts)).repartitionById(
        len(starts) + 2, F.col(PART)
    )
    in_range = Window.partitionBy(PART).orderBy(value.asc_nulls_last())
    return ranged.withColumn("upto", F.sum("n").over(in_range))


def chunk_manifest(df: DataFrame, cursor: str, chunk_rows: int = 1000) -> DataFrame:
    """Chunk number, its rows, and the watermark after it, for chunks in cursor order.

    Rows are first counted per cursor value (combined on the map side), so one
    value shared by a large part of the rows is a single counted entry.
    """
    size = max(1, chunk_rows)
    name = resolve(df.columns, cursor)
    kind = df.schema[name].dataType
    value = F.col("value")
    ranges = wanted_partitions(df.sparkSession, df)
    starts = [typed_literal(text, kind, name) for text in range_starts(df, name, ranges)]
    placed = materialize(_counted_in_ranges(df, name, starts), "chunks")

    ranges = (
        placed.groupBy(PART)
        .agg(F.max("upto").alias("n"), to_text(F.max("value"), kind, name).alias("top"))
        .orderBy(PART)
        .collect()
    )
    total = sum(r["n"] for r in ranges)
    top = next((r["top"] for r in reversed(ranges) if r["top"] is not None), None)

    end = F.col(BEFORE) + F.col("upto")
    start = end - F.col("n")
    # A chunk belongs to the value that holds its last row; the final one may be short.
    spans = (
        _with_offsets(placed, [(r[PART], r["n"]) for r in ranges])
        .select("value", start.alias("start"), end.alias("end"))
        .selectExpr(
            "value",
            f"start div {size} as first",
            f"if(end = {total}, ({total} - 1) div {size}, end div {size} - 1) as last",
        )
        .where("first <= last")
    )
    # A value with very many chunks is dealt out in blocks of them.
    block = F.lit(CHUNKS_PER_BLOCK)
    blocks = spans.select(
        "value", "last", F.explode(F.sequence("first", "last", block)).alias("first")
    ).repartition("first")
    chunks = blocks.select(
        "value",
        F.explode(F.sequence("first", F.least("last", F.col("first") + block - 1))).alias("chunk"),
    )
    return chunks.select(
        "chunk",
        F.least(F.lit(size), F.lit(total) - F.col("chunk") * size).cast("long").alias("rows"),
        F.coalesce(to_text(value, kind, name), F.lit(top)).alias("watermark"),
    )


def _with_tie_break(df: DataFrame, cursor: str, stable_input: bool) -> tuple[DataFrame, list]:
    """The frame with its input order as last sort key, and the whole sort order."""
    name = resolve(df.columns, cursor)
    source = df if stable_input else materialize(df, "input")
    tied = source.withColumn(TIE, F.monotonically_increasing_id())
    return tied, [F.col(ref(name)).asc_nulls_last(), F.col(TIE)]


def in_cursor_order(df: DataFrame, cursor: str, stable_input: bool = False) -> DataFrame:
    """A total sort for ordered exports: cursor ascending, NULLs last.

    Equal cursors keep their input order. That makes every sort key different,
    so a hot cursor value, or a row that is there a million times, is split over
    sort ranges like anything else. Input order must not change if a task runs
    again: pass ``stable_input=True`` only for a plain file scan, otherwise the
    input is written to the shared folder first.
    """
    tied, order = _with_tie_break(df, cursor, stable_input)
    return range_partitioned(tied, order).sortWithinPartitions(*order).drop(TIE)


def with_positions(
    df: DataFrame, cursor: str, stable_input: bool = False, name: str = "position"
) -> DataFrame:
    """Every row with its 0-based position in the order of :func:`in_cursor_order`."""
    tied, order = _with_tie_break(df, cursor, stable_input)
    ranged = (
        range_partitioned(tied, order)
        .sortWithinPartitions(*order)
        .withColumn(AT, F.monotonically_increasing_id())
        .withColumn(PART, F.shiftright(AT, _ROW_BITS).cast("int"))
        .drop(TIE)
    )
    placed = materialize(ranged, "positions")
    totals = [(r[PART], r["count"]) for r in placed.groupBy(PART).count().collect()]
    row = F.col(AT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return _with_offsets(placed, totals).select(
        (F.col(BEFORE) + row).alias(name), *[F.col(ref(c)) for c in df.columns]
    )


def with_chunks(
    df: DataFrame, cursor: str, chunk_rows: int = 1000, stable_input: bool = False
) -> DataFrame:
    """Every row with the number of its chunk, as counted by :func:`chunk_manifest`."""
    placed = with_positions(df, cursor, stable_input, AT)
    return placed.select(
        F.expr(f"{AT} div {max(1, chunk_rows)}").alias("chunk"),
        *[F.col(ref(c)) for c in df.columns],
    )
