"""Match incoming columns to a target by name, and convert them to its types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ColumnMismatch
from tidemark.functions.canonical import to_type
from tidemark.functions.names import position
from tidemark.operators.describe import numbered


def _matches(df: DataFrame, target: T.StructType) -> dict[str, int]:
    """Target column name to incoming position; strays and doubles are errors."""
    found: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        field = target[position(target.names, name)]
        if field.name in found:
            raise ColumnMismatch(f"two incoming columns match target column {field.name!r}")
        found[field.name] = i
    return found


def align(df: DataFrame, target: T.StructType, fill_missing: bool = False) -> DataFrame:
    """Incoming columns under the target's names, in its order and its types.

    Target columns that are not incoming are left out, or NULL with ``fill_missing``.
    """
    found = _matches(df, target)
    chosen = []
    for field in target:
        if field.name in found:
            i = found[field.name]
            value = to_type(F.col(f"c{i}"), df.schema[i].dataType, field.dataType, field.name)
            chosen.append(value.alias(field.name))
        elif fill_missing:
            chosen.append(F.lit(None).cast(field.dataType).alias(field.name))
    return numbered(df).select(chosen)


def append(target: DataFrame, new: DataFrame) -> DataFrame:
    """Target rows followed by new rows, matched by name; missing columns are NULL."""
    return target.unionByName(align(new, target.schema, fill_missing=True))
