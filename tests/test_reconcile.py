"""Checks of a copy, against row-by-row comparison."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.errors import ColumnMismatch
from tidemark.operators import reconcile
from tidemark.operators.reconcile import (
    differing_rows,
    mismatch_counts,
    reconcile_counts,
    reconcile_schema,
)

SCHEMA = "k int, a string, b double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_hand(source, copy):
    keys = {r[0] for r in source} | {r[0] for r in copy}
    found = []
    for k in keys:
        left = [r for r in source if r[0] == k]
        right = [r for r in copy if r[0] == k]
        if len(left) != len(right):
            found.append((k, "missing" if len(left) > len(right) else "extra", None))
        elif Counter(left) != Counter(right):
            columns = [
                c
                for i, c in ((1, "a"), (2, "b"))
                if Counter(r[i] for r in left) != Counter(r[i] for r in right)
            ]
            found.append((k, "changed", columns))
    return sorted(found, key=repr)


SOURCE = (
    [(1, "x", 1.0), (2, "", 2.0), (3, None, 3.0), (4, "y", None), (5, "same", 5.0)]
    + [(6, "p", 1.0), (6, "q", 2.0)]
    + [(7, "hot", float(i % 4)) for i in range(300)]
    + [(None, "n", 1.0)] * 2
    + [(8, "twice", 1.0)] * 2
)
COPY = (
    [(1, "x", 1.5), (2, None, 2.0), (3, "", None), (5, "same", 5.0), (9, "new", 9.0)]
    + [(6, "p", 2.0), (6, "q", 1.0)]  # values changed places: only whole rows differ
    + [(7, "hot", float(i % 4)) for i in reversed(range(300))]
    + [(None, "n", 1.0), (None, "n", 2.0)]
    + [(8, "other", 1.0)] * 2  # an even number of copies must not cancel out
)


def test_differences_equal_those_found_by_hand(spark):
    found = differing_rows(frame(spark, SOURCE), frame(spark, COPY), ["K"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand(SOURCE, COPY)


@pytest.mark.parametrize("few", [3, 1])
def test_rows_of_many_changed_keys_are_dealt_out(spark, monkeypatch, few):
    """By the number of keys, however few bytes they are; keys are null or of another type here and there."""
    rows = [(i, f"r{i}", float(i)) for i in range(9)] + [(None, "n", 1.0), (None, "n", 2.0)]
    changed = [(k, a, b + 1) for k, a, b in rows]
    monkeypatch.setattr(reconcile, "FEW_KEYS", few)
    dealt, repartition = set(), DataFrame.repartition
    counted = lambda df, n, *by: dealt.add(n) or repartition(df, n, *by)
    source, copy = frame(spark, rows), frame(spark, changed).withColumn("k", F.col("k").cast("long"))
    monkeypatch.setattr(DataFrame, "repartition", counted)
    found = differing_rows(source, copy, ["k"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == by_hand(rows, changed)
    assert dealt == {-(-10 // few)}


def test_equal_copies_have_no_differences(spark):
    source = frame(spark, SOURCE)
    assert differing_rows(source, source.select("b", "k", "a"), ["k"]).isEmpty()
    row = reconcile_counts(source, source.select("b", "a", "k").orderBy("b")).first()
    assert tuple(row) == (len(SOURCE), len(SOURCE), True)


@pytest.mark.parametrize("change", ["b", "a", "rows"])
def test_one_small_change_is_seen(spark, change):
    rows = [(i, f"r{i}", float(i)) for i in range(500)]
    changed = {
        "a": rows[:-1] + [(499, "r499 ", 499.0)],
        "b": rows[:-1] + [(499, "r499", 499.0000000001)],
        "rows": rows[:-1],
    }[change]
    row = reconcile_counts(frame(spark, rows), frame(spark, changed)).first()
    assert (row["rows_read"], row["rows_written"], row["same_content"]) == (500, len(changed), False)


@pytest.mark.parametrize("wider", ["bigint", "decimal(20,2)", "string"])
def test_a_wider_type_is_no_difference(spark, wider):
    rows = [(1, 10, b""), (2, None, None), (3, -7, b"x")]
    source = spark.createDataFrame(rows, "k int, n int, body binary")
    copy = source.withColumn("n", F.col("n").cast(wider)).withColumn("k", F.col("k").cast("bigint"))
    assert reconcile_counts(source, copy).first()["same_content"]
    assert differing_rows(source, copy, ["k"]).isEmpty()
    planted = copy.withColumn("n", F.when(F.col("k") == 3, F.lit(8).cast(wider)).otherwise(F.col("n")))
    assert not reconcile_counts(source, planted).first()["same_content"]
    assert [tuple(r) for r in differing_rows(source, planted, ["k"]).collect()] == [(3, "changed", ["n"])]
    emptied = copy.withColumn("body", F.coalesce("body", F.lit(b"")))
    assert [r["k"] for r in differing_rows(source, emptied, ["k"]).collect()] == [2]


def test_empty_sides(spark):
    nothing, something = frame(spark, SOURCE).where("false"), frame(spark, SOURCE)
    assert tuple(reconcile_counts(nothing, nothing).first()) == (0, 0, True)
    assert reconcile_counts(something, nothing).first()["same_content"] is False
    kinds = {r["kind"] for r in differing_rows(something, nothing, ["k"]).collect()}
    assert kinds == {"missing"}


def test_key_names_of_the_result_are_refused(spark):
    with pytest.raises(ColumnMismatch):
        df = frame(spark, SOURCE).withColumnRenamed("k", "Kind")
        differing_rows(df, df, ["kind"])


def test_mismatch_counts(spark):
    got = mismatch_counts(frame(spark, SOURCE), frame(spark, COPY), ["k"])
    expected = Counter(
        (kind, c) for _, kind, columns in by_hand(SOURCE, COPY) for c in (columns or ["*"])
    )
    assert {(r["kind"], r["column"]): r["keys"] for r in got.collect()} == expected


def test_schema_names_are_matched_as_written(spark):
    source = frame(spark, SOURCE)
    copy = source.withColumnRenamed("b", "B").withColumn("k", F.col("k").cast("long"))
    got = {r["name"]: r["verdict"] for r in reconcile_schema(source, copy).collect()}
    assert got == {"k": "type differs", "a": "same", "b": "missing", "B": "extra"}
