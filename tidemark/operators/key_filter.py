"""Bloom filters of keys as small tables: which keys may be among those of a load.

A filter is a table of 64-bit words, made by one grouping of key hashes and combined
before the shuffle. A key sets four bits of one word, so looking it up is an equi-join on
the number of the word. Keys that a filter denies are certainly not in the load; about one
in a hundred others are let through for nothing, and an exact join settles those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import ref

KEYS_PER_WORD = 4
WORD, BITS = "tm_word", "tm_bits"
_AGAIN, _MASK = "tm_again", "tm_mask"


def word_count(rows: int) -> int:
    """Words of a filter of so many keys: a power of two, so that loads share few sizes."""
    return 1 << max(0, (rows - 1) // KEYS_PER_WORD).bit_length()


def key_values(schema: T.StructType, keys: list[str]) -> list[Column]:
    """The key columns such that equal keys hash alike (0.0 and -0.0 are equal)."""
    floats = (T.FloatType, T.DoubleType)
    return [
        F.col(ref(k)) + F.lit(0.0) if isinstance(schema[k].dataType, floats) else F.col(ref(k))
        for k in keys
    ]


def _placed(rows: DataFrame, keys: list[str], words: int) -> DataFrame:
    """``rows`` with the word of their key and the bits it sets there."""
    values = key_values(rows.schema, keys)
    bits = " | ".join(f"shiftleft(1L, cast(({_AGAIN} >> {6 * i}) & 63 AS int))" for i in range(4))
    return (
        rows.withColumn(WORD, F.pmod(F.xxhash64(*values), F.lit(words)))
        .withColumn(_AGAIN, F.xxhash64(F.lit("again"), *values))
        .withColumn(_MASK, F.expr(bits))
        .drop(_AGAIN)
    )


def key_filter(rows: DataFrame, keys: list[str], words: int) -> DataFrame:
    """The filter of the keys of ``rows``; only rows with a full key may be given."""
    return (
        _placed(rows.select([ref(k) for k in keys]), keys, words)
        .groupBy(WORD)
        .agg(F.bit_or(_MASK).alias(BITS))
    )


def possible_keys(rows: DataFrame, keys: list[str], filters: DataFrame, words: int) -> DataFrame:
    """The keys of ``rows`` that one of ``filters`` (all of ``words`` words) does not deny."""
    placed = _placed(rows.select([ref(k) for k in keys]), keys, words)
    held = filters.select(F.col(WORD).alias("tm_at"), BITS)
    hit = (F.col(WORD) == F.col("tm_at")) & (F.col(BITS).bitwiseAND(F.col(_MASK)) == F.col(_MASK))
    return placed.join(held, hit, "left_semi").drop(WORD, _MASK)
