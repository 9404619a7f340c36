"""Compare a Spark result with DuckDB's, whole and in any row order."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(glob.glob(os.path.join(folder, "*.parquet"))):
        name = os.path.basename(file)[: -len(".parquet")]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return db


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, (bytearray, bytes)):
        return bytes(value).hex()
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def assert_same(frame, db, sql: str) -> None:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (
        f"missing {list(missing.items())[:3]} extra {list(extra.items())[:3]}"
    )
