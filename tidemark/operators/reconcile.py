"""Prove that a copy is a copy.

Sides are compared as signed groups, never joined: each side's rows are hashed,
combined on the map side, and summed with opposite signs. Repeated keys cost
nothing extra, and no pair of rows is ever formed.

Values are compared by their canonical text, so a copy in a wider type, or with its
numbers as text, is equal; ``reconcile_schema`` reports the types. Bytes, and types
without a canonical form, are compared as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ColumnMismatch, UnsupportedType
from tidemark.functions.canonical import load_value
from tidemark.functions.names import ref, resolve, resolve_all
from tidemark.operators.describe import numbered
from tidemark.sizing import scanned_bytes
from tidemark.storage import materialize


PIECES = range(4)
FEW_KEYS = 100_000  # changed keys that are broadcast; of more, what a task gets
BYTES_PER_TASK = 32 << 20  # of files, at most, for the rows of changed keys


def _comparable(value: Column, kind: T.DataType) -> Column:
    try:
        return load_value(value, kind)
    except UnsupportedType:
        return value


def _hash_pieces(values: list[Column]) -> list[Column]:
    """64-bit hash of the values in four 16-bit pieces; NULL and empty hash differently.

    Sums of a piece stay exact in a long for 2**47 rows, and two equal multisets of
    rows have equal sums.
    """
    marked = [part for v in values for part in (v, v.isNull())]
    hashed = F.xxhash64(*marked)
    return [F.shiftright(hashed, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in PIECES]


def row_hash_pieces(df: DataFrame, columns: list[str]) -> list[Column]:
    """The hash pieces of rows by the canonical text of these columns, in this order."""
    return _hash_pieces([_comparable(F.col(ref(c)), df.schema[c].dataType) for c in columns])


def reconcile_counts(source: DataFrame, copy: DataFrame) -> DataFrame:
    """One row: rows on each side, and whether the contents are the same multiset.

    The fingerprint is a sum of row hashes, so it depends on neither row order
    nor partitioning.
    """
    copy = copy.select([ref(resolve(copy.columns, c)) for c in source.columns])

    def summary(df: DataFrame, side: str) -> DataFrame:
        kinds = enumerate(f.dataType for f in df.schema)
        pieces = _hash_pieces([_comparable(F.col(f"c{i}"), kind) for i, kind in kinds])
        return numbered(df).agg(
            F.lit(side).alias("side"),
            F.count("*").alias("rows"),
            *[F.sum(piece).alias(f"sum_{i}") for i, piece in enumerate(pieces)],
        )

    # Two one-row summaries, folded into one row.
    both = summary(source, "read").unionAll(summary(copy, "written"))
    return both.agg(
        F.max(F.when(F.col("side") == "read", F.col("rows"))).alias("rows_read"),
        F.max(F.when(F.col("side") == "written", F.col("rows"))).alias("rows_written"),
        reduce(
            lambda a, b: a & b,
            # Sums of no rows are NULL.
            [F.min(c).eqNullSafe(F.max(c)) for c in ["rows", *[f"sum_{i}" for i in PIECES]]],
        ).alias("same_content"),
    )


def _fold(
    source: DataFrame, copy: DataFrame, keys: list[str], groups: list[list[str]]
) -> DataFrame:
    """Per key: rows on each side, and for each group of columns whether it differs."""

    def side(df: DataFrame, read: int, written: int) -> DataFrame:
        names = {c: resolve(df.columns, c) for g in [keys, *groups] for c in g}
        real = {c: F.col(ref(name)) for c, name in names.items()}
        text = {c: _comparable(real[c], df.schema[name].dataType) for c, name in names.items()}
        sign = F.lit(read - written)
        return df.select(
            *[real[k].alias(k) for k in keys],
            F.lit(read).alias("_read"),
            F.lit(written).alias("_written"),
            *[
                (sign * piece).alias(f"_{g}_{i}")
                for g, group in enumerate(groups)
                for i, piece in enumerate(_hash_pieces([text[c] for c in group]))
            ],
        )

    names = [f"_{g}_{i}" for g in range(len(groups)) for i in PIECES]
    folded = (
        side(source, 1, 0)
        .unionAll(side(copy, 0, 1))
        .groupBy([ref(k) for k in keys])
        .agg(*[F.sum(n).alias(n) for n in ["_read", "_written", *names]])
    )
    differs = [
        F.greatest(*[F.abs(f"_{g}_{i}") for i in PIECES]) > 0
        for g in range(len(groups))
    ]
    return folded.select(
        *[ref(k) for k in keys],
        "_read",
        "_written",
        F.array(*differs).alias("_differs"),
    )


def _rows_of(df: DataFrame, keys: list[str], wanted: DataFrame, tasks: int) -> DataFrame:
    """The rows whose keys are in ``wanted`` (column _key, a struct of the keys, nulls included).

    A task's rows and keys are bounded by the number of tasks asked for: left to itself, Spark
    joins partitions by their compressed bytes, and puts millions of narrow rows into one.
    """
    kinds = wanted.schema["_key"].dataType
    key = F.struct(
        *[F.col(ref(resolve(df.columns, k))).cast(f.dataType).alias(f.name) for k, f in zip(keys, kinds)]
    )
    keyed = df.withColumn("_key", key)
    if tasks > 1:
        keyed, wanted = keyed.repartition(tasks, "_key"), wanted.repartition(tasks, "_key").hint("merge")
    else:
        wanted = F.broadcast(wanted)
    return keyed.join(wanted, "_key", "left_semi").drop("_key")


def differing_rows(
    source: DataFrame, copy: DataFrame, keys: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Keys whose rows differ: ``missing`` or ``extra`` in the copy, or ``changed``.

    A key may repeat on a side; its rows are then compared as a multiset. Whole
    rows are compared first, so that only a key and one hash are shuffled; the
    columns that differ (``differing``) are then worked out for changed keys only.
    """
    keys = resolve_all(source.columns, keys)
    if taken := {"kind", "differing"} & {k.lower() for k in keys}:
        raise ColumnMismatch(f"rename the key columns {sorted(taken)}: the result has its own")
    columns = resolve_all(source.columns, columns or [c for c in source.columns if c not in keys])
    read, written = F.col("_read"), F.col("_written")

    whole = _fold(source, copy, keys, [columns])
    found = materialize(
        whole.where((read != written) | F.col("_differs")[0]).drop("_differs"), "differing"
    )
    changed = found.where(read == written).select(
        F.struct(*[F.col(ref(k)).alias(f"_{i}") for i, k in enumerate(keys)]).alias("_key")
    )
    tasks = -(-changed.count() // FEW_KEYS)
    if tasks > 1:
        tasks = max(tasks, *[-(-scanned_bytes(df) // BYTES_PER_TASK) for df in (source, copy)])

    def only_changed(df: DataFrame) -> DataFrame:
        return _rows_of(df, keys, changed, tasks)

    by_column = _fold(only_changed(source), only_changed(copy), keys, [[c] for c in columns])
    names = F.array(
        *[F.when(F.col("_differs")[i], F.lit(c)) for i, c in enumerate(columns)]
    )
    changes = by_column.select(
        *[ref(k) for k in keys],
        F.lit("changed").alias("kind"),
        F.array_compact(names).alias("differing"),
    )
    unequal = found.where(read != written).select(
        *[ref(k) for k in keys],
        F.when(read > written, "missing").otherwise("extra").alias("kind"),
        F.lit(None).cast("array<string>").alias("differing"),
    )
    return unequal.unionByName(changes)


def mismatch_counts(
    source: DataFrame, copy: DataFrame, keys: list[str], columns: list[str] | None = None
) -> DataFrame:
    """How many keys differ, per kind of difference and per column (``*``: whole rows)."""
    found = differing_rows(source, copy, keys, columns)
    return (
        found.select(
            "kind",
            F.explode(
                F.when(F.size("differing") > 0, F.col("differing")).otherwise(F.array(F.lit("*")))
            ).alias("column"),
        )
        .groupBy("kind", "column")
        .agg(F.count("*").alias("keys"))
    )


def reconcile_schema(source: DataFrame, copy: DataFrame) -> DataFrame:
    """One row per column of either side: its types, the verdict, the values present."""
    names = list(source.columns) + [c for c in copy.columns if c not in source.columns]

    def counted(df: DataFrame, side: str) -> DataFrame:
        present = numbered(df).agg(
            *[F.count(f"c{i}").alias(f"c{i}") for i in range(len(df.columns))]
        )
        return present.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(f.name).alias("name"),
                            F.lit(f.dataType.simpleString()).alias(f"{side}_type"),
                            F.col(f"c{i}").alias(f"{side}_values"),
                        )
                        for i, f in enumerate(df.schema)
                    ]
                )
            )
        )

    # One row per column on each side: the join is as wide as the schema, not the data.
    joined = counted(source, "source").join(counted(copy, "copy"), "name", "full_outer")
    verdict = (
        F.when(F.col("copy_type").isNull(), "missing")
        .when(F.col("source_type").isNull(), "extra")
        .when(F.col("source_type") != F.col("copy_type"), "type differs")
        .otherwise("same")
    )
    ordinal = F.array_position(F.lit(names), F.col("name")).cast("int") - 1
    return joined.select(
        ordinal.alias("ordinal"),
        "name",
        "source_type",
        "copy_type",
        verdict.alias("verdict"),
        "source_values",
        "copy_values",
    )
