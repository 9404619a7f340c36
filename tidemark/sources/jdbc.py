"""Reading a query from a database in parallel.

One connection per partition, each with its own range of a partition column, so
no connection and no task ever holds the whole result. The partition column need
not be the cursor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from decimal import Decimal, localcontext
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import UnsupportedType
from tidemark.functions.canonical import to_text, typed_literal
from tidemark.functions.names import quote_exact, ref, resolve
from tidemark.operators.incremental import Frontier, lower_bound

ALIAS = "q_"


#: Times without a zone stay so: as instants they would depend on the zone of the session.
_ZONELESS = {"preferTimestampNTZ": "true"}


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None):
    return spark.read.format("jdbc").option("url", url).options(**_ZONELESS, **(properties or {}))


def as_subquery(query: str) -> str:
    """The user's query as a table expression; ``query=`` cannot be read in partitions."""
    return f"({query}) {ALIAS}"


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    fetch_rows: int = 1000,
) -> DataFrame:
    """The query over one connection: for small results, and to describe a schema."""
    return (
        _reader(spark, url, properties)
        .option("dbtable", as_subquery(query))
        .option("fetchsize", max(1, fetch_rows))
        .load()
    )


def read_in_ranges(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str,
    partitions: int,
    properties: Mapping[str, str] | None = None,
    fetch_rows: int = 1000,
) -> DataFrame:
    """Ranges of a number, date or timestamp column that hold about as many rows each.

    The ranges come from histograms the database makes of the query, a few grouped rows
    each; they only shape the ranges, so rows outside them and NULLs are still read (by the
    last and the first range). The ranges are predicates made here: Spark's own take whole
    numbers only, and are equal in width, however bunched the values are.
    """
    schema = read_query(spark, url, query, properties).schema
    name = resolve(schema.names, partition_column)
    kind = schema[name].dataType
    column = quote_exact(name)

    def ask(cuts: list[str]) -> list[Cell]:
        literals = [sql_literal(cut, kind, name) for cut in cuts]
        asked = histogram_query(as_subquery(query), column, literals)
        found = read_query(spark, url, asked, properties)
        low, high, count = (F.col(ref(c)) for c in found.columns)
        ends = [to_text(c.cast(kind), kind, name) for c in (low, high)]
        rows = found.select(*ends, count.cast("long")).collect()  # a row per cut
        return [Cell(*row) for row in rows]

    splits = [sql_literal(s, kind, name) for s in even_split_points(ask, kind, partitions)]
    if not splits:
        return read_query(spark, url, query, properties, fetch_rows)
    predicates = range_predicates(column, splits)
    return read_by_predicates(spark, url, query, predicates, properties, fetch_rows)


class Cell(NamedTuple):
    """A range of a column's values: the least and the greatest there (canonical text), its rows."""

    low: str
    high: str
    rows: int


def histogram_query(table: str, column: str, cuts: Sequence[str]) -> str:
    """Least and greatest value and number of rows of each range cut at ``cuts`` (SQL literals)."""
    cell = "0"
    if cuts:
        whens = " ".join(f"WHEN {column} < {cut} THEN {i}" for i, cut in enumerate(cuts))
        cell = f"CASE {whens} ELSE {len(cuts)} END"
    inner = f"SELECT {column} AS v_, {cell} AS cell_ FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT MIN(v_) AS lo_, MAX(v_) AS hi_, COUNT(*) AS n_ FROM ({inner}) h_ GROUP BY cell_"


def _sort_key(text: str, kind: T.DataType):
    if isinstance(kind, T.DateType):
        return text[:10]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return text
    return Decimal(text)


def even_split_points(
    ask: Callable[[list[str]], list[Cell]], kind: T.DataType, partitions: int, fine: int = 4
) -> list[str]:
    """Up to ``partitions - 1`` values that cut a column into ranges of about as many rows.

    ``ask`` gives the histogram of the ranges between some cuts. Ranges with more than a
    ``fine``-th of a part's rows are cut again, by width between the values they really
    hold, until none is left that can be; light neighbours are put together before, so a
    histogram has a bounded number of ranges. A value with more rows than that is one range.
    """
    cells = ask([])
    total = sum(cell.rows for cell in cells)
    if not total:
        return []
    light = max(1, total // (partitions * fine))
    while True:
        cuts: list[str] = []
        heavy, held = False, 0
        for cell in cells:
            if held + cell.rows > light:
                cuts.append(cell.low)
                held = 0
            held += cell.rows
            if cell.rows > light and cell.low != cell.high:
                # Both ends are values of the cell, so each cut leaves less on either side.
                low = _sort_key(cell.low, kind)
                inner = split_points(cell.low, cell.high, kind, 8)
                cuts += [p for p in inner if _sort_key(p, kind) > low] or [cell.high]
                heavy = True
        again = sorted(ask(cuts), key=lambda cell: _sort_key(cell.low, kind)) if heavy else cells
        if again == cells:
            break
        cells = again
    points, before = [], 0
    for cell in cells:
        wanted = total * (len(points) + 1) / partitions
        # Cut in front of the cell that goes past the next share, if that is nearer.
        if before and before + cell.rows / 2 > wanted and len(points) < partitions - 1:
            points.append(cell.low)
        before += cell.rows
    return points


def split_points(low: str, high: str, kind: T.DataType, partitions: int) -> list[str]:
    """Up to ``partitions - 1`` ascending values between two canonical texts, evenly spaced."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        first, last = (datetime.fromisoformat(t.replace(" +", "+")) for t in (low, high))
        at = [first + (last - first) * i / partitions for i in range(1, partitions)]
        dates = isinstance(kind, T.DateType)
        points = [p.isoformat(" ", "microseconds")[: 10 if dates else None] for p in at]
        if isinstance(kind, T.TimestampType):
            points = [p.replace("+00:00", " +00:00") for p in points]
    elif isinstance(kind, T.NumericType):
        first, last = Decimal(low), Decimal(high)
        if not (first.is_finite() and last.is_finite()):
            return []
        with localcontext(prec=80):
            at = [first + (last - first) * i / partitions for i in range(1, partitions)]
            if isinstance(kind, (T.FloatType, T.DoubleType)):
                at = [Decimal(repr(float(p))) for p in at]
            else:
                unit = Decimal(1).scaleb(-getattr(kind, "scale", 0))
                at = [p.quantize(unit) for p in at]
        points = [f"{p:f}" for p in at]
    else:
        raise UnsupportedType(f"ranges of {kind.simpleString()}: give predicates instead")
    return [p for p, before in zip(points, [None, *points]) if p != before]


def sql_literal(text: str, kind: T.DataType, name: str = "?") -> str:
    """Watermark text as a standard SQL literal of the cursor's type."""
    typed_literal(text, kind, name)  # unreadable text fails here
    if isinstance(kind, T.DateType):
        return f"DATE '{text[:10]}'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"TIMESTAMP '{text}'"
    if isinstance(kind, T.StringType):
        return "'" + text.replace("'", "''") + "'"
    return text


def bounded_query(query: str, column: str, low: str | None = None, high: str | None = None) -> str:
    """The query cut to ``low < column <= high`` (SQL literals); NULLs only without ``low``.

    ``column`` is the name the database gives it.
    """
    quoted = quote_exact(column)
    conditions = [] if low is None else [f"{quoted} > {low}"]
    if high is not None:
        under = f"{quoted} <= {high}"
        conditions.append(under if low is not None else f"({under} OR {quoted} IS NULL)")
    if not conditions:
        return query
    return f"SELECT * FROM {as_subquery(query)} WHERE " + " AND ".join(conditions)


def frontier_query(query: str, column: str) -> str:
    """The highest cursor of a query, and its number of rows."""
    return f'SELECT MAX({quote_exact(column)}) "HI", COUNT(*) "N" FROM {as_subquery(query)}'


@dataclass(frozen=True)
class QuerySource:
    """A database query with a cursor column, read one run at a time in parallel.

    The bounds are put into the query itself. A filter on a frame would be pushed to
    the database just as well, but the ranges would then span the whole table, and one
    connection would get most of the new rows. ``predicates`` take the place of ranges of
    the partition column where those would be uneven.
    """

    spark: SparkSession
    url: str
    query: str
    cursor: str
    partition_column: str
    partitions: int
    properties: Mapping[str, str] | None = None
    fetch_rows: int = 1000
    predicates: Sequence[str] | None = None

    def schema(self) -> T.StructType:
        """From the database's description of the query; no rows are read."""
        return read_query(self.spark, self.url, self.query, self.properties).schema

    def increment(
        self, stored: object | None, initial: object | None, ceiling: str | None = None
    ) -> str:
        """The query cut to one run."""
        schema = self.schema()
        name = resolve(schema.names, self.cursor)
        kind = schema[name].dataType
        bounds = (lower_bound(stored, initial), ceiling)
        literals = [None if b is None else sql_literal(b, kind, name) for b in bounds]
        return bounded_query(self.query, name, *literals)

    def look_ahead(self, stored: object | None, initial: object | None) -> Frontier:
        """Worked out by the database: one row is fetched."""
        schema = self.schema()
        name = resolve(schema.names, self.cursor)
        kind = schema[name].dataType
        summary = frontier_query(self.increment(stored, initial), name)
        found = read_query(self.spark, self.url, summary, self.properties)
        high, count = (F.col(c) for c in found.columns)
        row = found.select(to_text(high.cast(kind), kind, name).alias("hi"), count).first()
        return Frontier(row[0], int(row[1]))

    def read(
        self, stored: object | None, initial: object | None, ceiling: str | None
    ) -> DataFrame:
        query = self.increment(stored, initial, ceiling)
        if self.predicates:
            return read_by_predicates(
                self.spark, self.url, query, self.predicates, self.properties, self.fetch_rows
            )
        return read_in_ranges(
            self.spark,
            self.url,
            query,
            self.partition_column,
            self.partitions,
            self.properties,
            self.fetch_rows,
        )

    def without_nulls(self) -> QuerySource:
        column = quote_exact(resolve(self.schema().names, self.cursor))
        rows = f"SELECT * FROM {as_subquery(self.query)} WHERE {column} IS NOT NULL"
        return replace(self, query=rows)


def range_predicates(column: str, splits: Sequence[str]) -> list[str]:
    """Ranges cut at ``splits`` (SQL literals in ascending order), NULLs in the first.

    For columns without a usable stride: text, or numbers bunched in a few
    places, where equal-width ranges would leave one connection with the bulk.
    """
    if not splits:
        return ["1 = 1"]
    first = f"({column} < {splits[0]} OR {column} IS NULL)"
    middle = [f"({column} >= {a} AND {column} < {b})" for a, b in zip(splits, splits[1:])]
    return [first, *middle, f"({column} >= {splits[-1]})"]


def hash_predicates(hash_expression: str, partitions: int) -> list[str]:
    """Remainder classes of a database-side row hash, e.g. one over the row address.

    Splits any table evenly, however skewed its columns are.
    """
    value = f"ABS(COALESCE({hash_expression}, 0))"
    return [f"MOD({value}, {partitions}) = {i}" for i in range(partitions)]


def read_by_predicates(
    spark: SparkSession,
    url: str,
    query: str,
    predicates: Sequence[str],
    properties: Mapping[str, str] | None = None,
    fetch_rows: int = 1000,
) -> DataFrame:
    options = {**_ZONELESS, **(properties or {}), "fetchsize": str(max(1, fetch_rows))}
    return spark.read.jdbc(url, as_subquery(query), predicates=list(predicates), properties=options)
