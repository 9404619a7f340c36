"""Line dedup: passages of three lines that occur again anywhere are removed there.

Every three consecutive lines of a text are a window, known by 128 bits of hash. Windows
are grouped over the whole corpus; the first occurrence, by (doc_id with nulls last, hash
of the text, place), stays. Each later one covers its three lines; the covered places of a
text are merged and those lines go, the others stay as they are.

Lines end at ``\\n`` and are compared exactly. Windows without any word do not count. Texts
of fewer than three lines, empty and null texts are left alone. Rows equal in id and text
are one document: they come out alike, and do not make each other's windows repeated.
Other columns are handed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_key, written

WINDOW = 3
_PLACE = ["no_id", "doc_id", "text_key", "line"]


def _windows(docs: DataFrame) -> DataFrame:
    """hash_a, hash_b and the occurrence of every window that has a word."""
    lines = docs.where(F.contains("text", F.lit("\n"))).select(
        F.col("doc_id").isNull().alias("no_id"),
        "doc_id",
        text_key(F.col("text")).alias("text_key"),
        F.split("text", "\n").alias("lines"),
    )

    def window(i):
        a, b, c = (F.get("lines", i + k) for k in range(WINDOW))
        return F.struct(
            i.alias("line"),
            F.xxhash64(a, b, c).alias("hash_a"),
            F.xxhash64(F.lit("b"), c, b, a).alias("hash_b"),
            F.concat(a, b, c).rlike(r"[^\x20\x09-\x0D]").alias("has_word"),
        )

    starts = F.sequence(F.lit(0), F.size("lines") - WINDOW)
    return (
        lines.where(F.size("lines") >= WINDOW)
        .select("no_id", "doc_id", "text_key", F.inline(F.transform(starts, window)))
        .where("has_word")
        .drop("has_word")
    )


def covered_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key and the places of the windows that repeat an earlier one.

    One shuffle of the windows finds the first occurrences (combined before it, so a
    window that every document holds is one row a task); the second, a join, is of inner
    kind, so Spark may split such a window.
    """
    windows = _windows(docs)
    place = F.struct(*_PLACE)
    repeated = written(
        windows.groupBy("hash_a", "hash_b")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("hash_a", "hash_b", "first"),
        "repeated",
    )
    later = windows.join(repeated, ["hash_a", "hash_b"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned text, and n_lines, n_removed (long) in a last column ``__lines``."""
    covered = covered_lines(docs).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "starts"
    )
    given = docs.select(
        F.struct("*").alias("__row"), "doc_id", "text", text_key(F.col("text")).alias("__text")
    )
    joined = given.join(
        covered,
        given["doc_id"].eqNullSafe(covered["__id"]) & (given["__text"] == covered["__key"]),
        "left",
    ).withColumn("lines", F.split("text", "\n"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    gone = F.flatten(F.transform("starts", lambda i: F.array(*[i + k for k in range(WINDOW)])))
    # Merged: a place that several windows cover is taken out once.
    joined = joined.withColumn(
        "kept", F.when(F.col("starts").isNotNull(), F.array_except(every, gone))
    )
    text = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(n_lines)
    removed = F.coalesce(F.size("lines") - F.size("kept"), F.lit(0))
    removed = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(removed)
    return joined.select(
        *[
            F.coalesce(text, F.col("text")).alias(name) if name == "text" else F.col("__row")[name].alias(name)
            for name in docs.columns
        ],
        F.struct(
            n_lines.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed")
        ).alias("__lines"),
    )


def line_digest(documents: DataFrame) -> DataFrame:
    """Every document with its text as it stays."""
    return dedup_lines(documents.select("doc_id", "text")).select(
        "doc_id", "text", "__lines.n_lines", "__lines.n_removed"
    )


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents with repeated passages removed; n_chars follows the text."""
    cleaned = dedup_lines(documents).drop("__lines")
    if "n_chars" in documents.columns:
        cleaned = cleaned.withColumn(
            "n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)
        )
    return cleaned
