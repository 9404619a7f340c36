"""Describe a query without reading it, and project it to its canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.canonical import (
    canonical_type,
    check_supported,
    extract_value,
    load_value,
)


def numbered(df: DataFrame) -> DataFrame:
    """The same frame with columns ``c0, c1, ...``, so any column name can be addressed."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def canonical_schema(schema: T.StructType) -> T.StructType:
    """The schema an extract has: canonical types, every field nullable."""
    for field in schema:
        check_supported(field.name, field.dataType)
    return T.StructType(
        [T.StructField(f.name, canonical_type(f.dataType), True) for f in schema]
    )


def canonical(df: DataFrame) -> DataFrame:
    """The extract projection: one select of built-in expressions, same column names."""
    return numbered(df).select(
        [
            extract_value(F.col(f"c{i}"), f.dataType, f.name).alias(f.name)
            for i, f in enumerate(df.schema)
        ]
    )


def as_load_text(df: DataFrame) -> DataFrame:
    """Every column as the text a load binds (bytes stay bytes)."""
    return numbered(df).select(
        [
            load_value(F.col(f"c{i}"), f.dataType, f.name).alias(f.name)
            for i, f in enumerate(df.schema)
        ]
    )


def describe(df: DataFrame) -> DataFrame:
    """One row per column from the schema alone; no data is read."""
    target = canonical_schema(df.schema)
    rows = [
        (i, f.name, f.dataType.simpleString(), t.dataType.simpleString())
        for i, (f, t) in enumerate(zip(df.schema, target))
    ]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, name string, source_type string, canonical_type string"
    )


def _one_row_per_column(df: DataFrame, shape) -> DataFrame:
    counted = numbered(df).agg(
        *[F.count(f"c{i}").alias(f"c{i}") for i in range(len(df.columns))],
    )
    return counted.select(F.inline(F.array(*[shape(i) for i in range(len(df.columns))])))


def profile_columns(df: DataFrame) -> DataFrame:
    """:func:`describe` with the number of values present in each column."""
    target = canonical_schema(df.schema)

    def shape(i: int) -> Column:
        return F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(df.schema[i].name).alias("name"),
            F.lit(df.schema[i].dataType.simpleString()).alias("source_type"),
            F.lit(target[i].dataType.simpleString()).alias("canonical_type"),
            F.col(f"c{i}").alias("values_present"),
        )

    return _one_row_per_column(df, shape)
