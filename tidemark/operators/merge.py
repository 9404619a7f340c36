"""Keyed upsert as a planned join.

A match overwrites every incoming non-key column, NULL included; a row without
a match is inserted; target columns that are not incoming keep their value.
A NULL in any key column never matches.

Shape of the plan: one full outer join on the key, so each side is read and
shuffled once. Rows with a NULL key bypass it, so they are never gathered in one
shuffle partition. Keys are unique on both sides: staged ones are checked, and a
file target refuses a second row for a key. In a frame that repeats a key all its
rows are updated, but by one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import KeyProblem
from tidemark.functions.names import ref, resolve_all
from tidemark.operators.align import align


SIDE = "tm_side"
KEPT, UPDATED, INSERTED = range(3)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_key(keys: list[str]) -> Column:
    return _all([F.col(ref(k)).isNotNull() for k in keys])


def merge_keys(columns: list[str], keys: list[str]) -> list[str]:
    """The key columns by their real names; at least one, all present."""
    if not keys:
        raise KeyProblem("an upsert needs at least one merge key")
    return resolve_all(columns, keys)


def duplicate_keys(stage: DataFrame, keys: list[str]) -> DataFrame:
    """Fully non-NULL keys that occur more than once, with their number of rows."""
    keys = merge_keys(stage.columns, keys)
    return (
        stage.where(has_key(keys))
        .groupBy([ref(k) for k in keys])
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def require_unique_keys(stage: DataFrame, keys: list[str]) -> None:
    """Fail before anything is written if a staged key is repeated."""
    samples = duplicate_keys(stage, keys).limit(3).collect()
    if samples:
        shown = "; ".join(str(row.asDict()) for row in samples)
        raise KeyProblem(f"the staged rows repeat merge keys, for example {shown}")


def merge_rows(
    target: DataFrame, stage: DataFrame, keys: list[str], order: str | None = None
) -> DataFrame:
    """The target's rows after the merge, each with what became of it in ``SIDE``.

    ``SIDE`` is KEPT, UPDATED (a staged row has the key) or INSERTED. With ``order``, a
    column of both sides, a staged row that comes before the target's row changes nothing;
    one without an order comes before any that has one.
    """
    stage = align(stage, target.schema)
    keys = merge_keys(stage.columns, keys)
    staged_name = {c: f"_staged_{i}" for i, c in enumerate(stage.columns)}
    renamed = stage.toDF(*staged_name.values())
    same_key = _all([F.col(ref(k)) == F.col(staged_name[k]) for k in keys])
    staged_has_key = has_key([staged_name[k] for k in keys])

    held = target.where(has_key(keys)).withColumn("_held", F.lit(True))
    arrived = renamed.where(staged_has_key).withColumn("_arrived", F.lit(True))
    is_held, has_arrived = F.col("_held").isNotNull(), F.col("_arrived").isNotNull()

    wins = has_arrived
    if order is not None:
        order = resolve_all(stage.columns, [order])[0]
        now, old = F.col(staged_name[order]), F.col(ref(order))
        wins = has_arrived & F.coalesce(old.isNull() | (now >= old), F.lit(False))

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(ref(name)), F.col(staged_name[name]))
        if name in staged_name:
            return F.when(wins, F.col(staged_name[name])).otherwise(F.col(ref(name)))
        return F.col(ref(name))

    side = (
        F.when(is_held & has_arrived, F.lit(UPDATED))
        .when(is_held, F.lit(KEPT))
        .otherwise(F.lit(INSERTED))
    )
    keyed = held.join(arrived, same_key, "full_outer").select(
        *[value(c).alias(c) for c in target.columns], side.alias(SIDE)
    )
    added = renamed.where(~staged_has_key).select(
        *[
            F.col(staged_name[f.name]).alias(f.name)
            if f.name in staged_name
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema
        ],
        F.lit(INSERTED).alias(SIDE),
    )
    keyless = target.where(~has_key(keys)).withColumn(SIDE, F.lit(KEPT))
    return keyed.unionByName(keyless).unionByName(added)


def upsert(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """The whole target after the merge. Staged keys must be unique (see above)."""
    return merge_rows(target, stage, keys).drop(SIDE)


def load_report(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """What an upsert will do, in one row: received, inserted, updated, kept.

    One grouping over the keys of both sides, combined on the map side; no join.
    """
    stage = align(stage, target.schema)
    keys = merge_keys(stage.columns, keys)
    columns = [F.col(ref(k)).alias(f"k{i}") for i, k in enumerate(keys)]
    sides = target.select(*columns, F.lit(1).alias("old"), F.lit(0).alias("new")).unionAll(
        stage.select(*columns, F.lit(0).alias("old"), F.lit(1).alias("new"))
    )
    names = [f"k{i}" for i in range(len(keys))]
    per_key = sides.groupBy(names).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    matched = has_key(names) & (F.col("old") > 0) & (F.col("new") > 0)

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("long")

    return per_key.agg(
        F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("received"),
        total("new", ~matched).alias("inserted"),
        total("old", matched).alias("updated"),
        total("old", ~matched).alias("kept"),
    )
