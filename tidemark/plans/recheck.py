"""Check a copy again without reading what is the same.

Both sides are file targets of one layout, so a key is in the same folder (period and
bucket) of either. Their digests form a tree: of files, kept beside the data; of folders,
the sums of their files'; of the whole, the sum of all. Folders with equal digests are left
alone; of the others the rows are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import KeyProblem
from tidemark.functions.names import ref, resolve_all
from tidemark.operators.reconcile import PIECES, differing_rows
from tidemark.sinks.files import FileTarget

_NUMBERS = ["rows", *[f"sum_{i}" for i in PIECES]]


def _place(layout: list[str]) -> Column:
    """The folder of a row, as text: of folder columns only, so it is decided before a scan."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in layout])


def differing_folders(source: FileTarget, copy: FileTarget) -> list[str]:
    """The folders whose digests differ; at most one row a folder comes back."""
    ours, theirs = source.version(), copy.version()
    if (ours.keys, ours.period, ours.buckets) != (theirs.keys, theirs.period, theirs.buckets):
        raise KeyProblem("only targets of the same keys, period and buckets can be compared by folder")
    if not ours.keys:
        raise KeyProblem("targets without keys have no folders to compare")
    layout = source._layout(ours)

    def side(target: FileTarget, sign: int) -> DataFrame:
        signed = [(F.lit(sign) * F.col(c)).alias(c) for c in _NUMBERS]
        return target.digests().select(_place(layout).alias("place"), *signed)

    both = side(source, 1).unionAll(side(copy, -1)).groupBy("place")
    sums = both.agg(*[F.sum(c).alias(c) for c in _NUMBERS])
    unequal = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _NUMBERS])
    return sorted(r["place"] for r in sums.where(unequal).select("place").collect())


def recheck(source: FileTarget, copy: FileTarget) -> DataFrame:
    """:func:`differing_rows` of two targets, reading only folders that differ."""
    folders = differing_folders(source, copy)
    names = source.schema().names

    def rows(target: FileTarget) -> DataFrame:
        version = target.version()
        here = target._rows(version).where(_place(target._layout(version)).isin(folders))
        return here.select([ref(c) for c in resolve_all(target.schema().names, names)])

    return differing_rows(rows(source), rows(copy), source.version().keys)
