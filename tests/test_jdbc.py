"""The JDBC paths without a database: statements, predicates, transactions.

The statements are run by DuckDB, the predicates by Spark over whole tables.
"""

from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import ColumnMismatch, KeyProblem, TidemarkError, UnsupportedType
from tidemark.functions.names import resolve
from tidemark.operators.incremental import frontier, read_past
from tidemark.plans.state import SyncState
from tidemark.plans.sync import sync_to
from tidemark.sinks import jdbc
from tidemark.sources import jdbc as source
from tidemark.sources.jdbc import as_subquery, hash_predicates, range_predicates


@pytest.fixture
def db():
    db = duckdb.connect()
    db.execute('CREATE TABLE "SINK" ("ID" INTEGER, "NAME" VARCHAR, "TS" TIMESTAMP, "EXTRA" VARCHAR)')
    db.execute("INSERT INTO sink VALUES (1, 'a', '2024-01-01', 'x'), (2, 'b', '2024-01-02', 'y')")
    return db


def stage(db, name, rows):
    db.execute(jdbc.staging_statement("sink", name))
    for number, row in rows:
        db.execute(
            f'INSERT INTO "{name}" ("ID", "NAME", "TS", "{jdbc.ROW_NUMBER}") VALUES (?, ?, ?, ?)',
            [*row, number],
        )


NEW = [
    (0, (2, None, "2024-02-02")),
    (1, (3, "c", "2024-02-03")),
    (2, (None, "d", "2024-02-04")),
    # A task that ran twice.
    (1, (3, "c", "2024-02-03")),
    (2, (None, "d", "2024-02-04")),
]


def found(db):
    rows = db.execute('SELECT "ID", "NAME", CAST("TS" AS DATE), "EXTRA" FROM "SINK"').fetchall()
    return sorted(((a, b, str(c), d) for a, b, c, d in rows), key=repr)


def test_append_takes_every_staged_row_once(db):
    stage(db, "STG", NEW)
    db.execute(jdbc.insert_statement("sink", "STG", ["ID", "NAME", "TS"]))
    assert found(db) == sorted(
        [
            (1, "a", "2024-01-01", "x"),
            (2, "b", "2024-01-02", "y"),
            (2, None, "2024-02-02", None),
            (3, "c", "2024-02-03", None),
            (None, "d", "2024-02-04", None),
        ],
        key=repr,
    )


def test_merge_updates_with_nulls_keeps_other_columns_and_inserts(db):
    stage(db, "STG", NEW)
    sql = jdbc.merge_statement("sink", "STG", ["ID", "NAME", "TS"], ["id"])
    db.execute(sql)
    expected = [
        (1, "a", "2024-01-01", "x"),
        (2, None, "2024-02-02", "y"),
        (3, "c", "2024-02-03", None),
        (None, "d", "2024-02-04", None),
    ]
    assert found(db) == sorted(expected, key=repr)


def test_merge_with_nothing_but_keys_only_inserts(db):
    sql = jdbc.merge_statement("sink", "STG", ["ID", "NAME"], ["ID", "NAME"])
    assert "WHEN MATCHED" not in sql
    stage(db, "STG", [(0, (1, "a", None)), (1, (5, "e", None))])
    db.execute(sql)
    assert [r[0] for r in found(db)] == [1, 2, 5]


def test_merge_keys_are_checked():
    with pytest.raises(ColumnMismatch):
        jdbc.merge_statement("t", "s", ["A"], ["B"])
    with pytest.raises(KeyProblem):
        jdbc.merge_statement("t", "s", ["A"], [])


def test_staging_tables_are_of_one_run():
    first, second = jdbc.staging_name("sales.sink"), jdbc.staging_name("sales.sink")
    assert first != second and first.startswith("sales.") and len(first.split(".")[1]) <= 30


EVENTS = "/root/testdata/sf0.01/events.parquet"


@pytest.mark.parametrize(
    ("cursor", "low"),
    [
        ("EVENT_ID", "5000"),
        ("ts", "2024-01-20 12:00:00.000000"),
        ("event_type", "o'brien"),
        ("value", "100.5"),
        ("ts", None),
    ],
)
def test_the_database_finds_the_frontier(spark, monkeypatch, cursor, low):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{EVENTS}'")
    events = spark.read.parquet(EVENTS)

    def read_query(session, url, query, properties=None, fetch_rows=1000):
        if query == "SELECT * FROM events":
            return events
        value, count = db.execute(query).fetchall()[0]
        kind = events.schema[resolve(events.columns, cursor)].dataType.simpleString()
        return session.createDataFrame([(value, count)], f"HI {kind}, N long")

    monkeypatch.setattr(source, "read_query", read_query)
    orders = source.QuerySource(spark, "jdbc:none", "SELECT * FROM events", cursor, "event_id", 4)
    assert orders.look_ahead(low, None) == frontier(events, cursor, low)


@pytest.mark.parametrize(
    ("cursor", "resume", "initial", "upto"),
    [
        ("event_id", None, None, None),
        ("EVENT_ID", "100", "5", "9000"),
        ("ts", None, "2024-01-03 00:00:00.000000", "2024-01-20 12:00:00.000000"),
        ("maybe", None, None, "2024-01-20 12:00:00.000000"),
        ("maybe", "2024-01-10 00:00:00.000000", None, None),
        ("event_type", "o'brien", None, "signup"),
    ],
)
def test_the_database_cuts_the_query_to_one_run(
    spark, monkeypatch, cursor, resume, initial, upto
):
    db = duckdb.connect()
    sql = (
        "SELECT event_id, event_type, ts, CASE WHEN event_type <> 'error' THEN ts END AS maybe "
        "FROM {events}"
    )
    events = spark.sql(sql, events=spark.read.parquet(EVENTS))
    query = sql.replace("{events}", f"'{EVENTS}'")
    monkeypatch.setattr(source, "read_query", lambda *_: events)
    increments = source.QuerySource(spark, "jdbc:none", query, cursor, "event_id", 4)
    cut = increments.increment(resume, initial, upto)
    expected = read_past(events, cursor, resume, initial, upto).select("event_id").collect()
    found = db.execute(f"SELECT event_id FROM {as_subquery(cut)}").fetchall()
    assert sorted(found) == sorted(tuple(r) for r in expected)


def test_sql_literals():
    assert source.sql_literal("it's", T.StringType()) == "'it''s'"
    assert source.sql_literal("2024-01-01 00:00:00", T.DateType()) == "DATE '2024-01-01'"
    with pytest.raises(TidemarkError):
        source.sql_literal("1; DROP TABLE t", T.LongType())


VALUES = [
    (1, "-70.5000000000", -7.25, "2023-12-31", "2023-12-31 23:59:59.5"),
    (2, "0.0000000001", 0.0, "2024-01-01", "2024-03-10 02:30:00"),
    (3, "1000000000000.0000000000", 1e12, "2024-02-29", "2024-11-03 01:30:00"),
    (4, None, None, None, None),
    *[(i, f"{i}.1250000000", i / 8, f"2024-05-{i % 28 + 1:02}", f"2024-05-01 00:00:{i}") for i in range(10, 40)],
]
COLUMNS = {"Price": "decimal(38,10)", "Ratio": "double", "Day": "date", "At": "timestamp_ntz", "Id": "int"}


@pytest.fixture
def mixed(spark, monkeypatch):
    """A DuckDB table read in place of a server; gives the predicates asked for."""
    db = duckdb.connect()
    db.execute('CREATE TABLE t ("Id" INT, "Price" DECIMAL(38,10), "Ratio" DOUBLE, "Day" DATE, "At" TIMESTAMP)')
    db.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?)", VALUES)
    asked = []

    def read_query(session, url, query, properties=None, fetch_rows=1000):
        rows = db.execute(query).fetchall()
        if "MIN(" in query:
            kind = COLUMNS[query.split('"')[1]]
            return session.createDataFrame(rows, f"LO_ {kind}, HI_ {kind}, N_ long")
        schema = ", ".join(f"{c} {COLUMNS[c]}" for c in ("Id", "Price", "Ratio", "Day", "At"))
        return session.createDataFrame(rows, schema)

    monkeypatch.setattr(source, "read_query", read_query)
    monkeypatch.setattr(source, "read_by_predicates", lambda s, u, q, predicates, *_: asked.extend(predicates))
    return db, asked


@pytest.mark.parametrize("column", list(COLUMNS))
def test_ranges_of_any_ordered_column_give_every_row_once(spark, mixed, column):
    db, asked = mixed
    source.read_in_ranges(spark, "jdbc:none", "SELECT * FROM t", column, 5)
    assert len(asked) == 5
    parts = [db.execute(f'SELECT "Id" FROM t WHERE {p}').fetchall() for p in asked]
    assert sorted(i for part in parts for i in part) == sorted((v[0],) for v in VALUES)
    # The rows that have a value are 33; the one without is in the first part.
    assert max(len(part) for part in parts) <= 2 * len(VALUES) / 5


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_even_splits_of_any_bunched_column(parts):
    rng = random.Random(parts)
    for shape in range(6):
        values = {
            0: [rng.randrange(10) ** 20 for _ in range(500)],
            1: [rng.randrange(50) + 10**30 * (rng.random() < 0.01) for _ in range(800)],
            2: [2**rng.randrange(120) for _ in range(700)],
            3: [7] * 300,
            4: [],
            5: [rng.randrange(10**6) for _ in range(1000)] + [123] * 400,
        }[shape]
        asked = []

        def ask(cuts):
            asked.append(len(cuts))
            cells = {}
            for v in values:
                cells.setdefault(sum(Decimal(c) <= v for c in cuts), []).append(v)
            return [source.Cell(str(min(c)), str(max(c)), len(c)) for c in rng.sample(list(cells.values()), len(cells))]

        points = [Decimal(p) for p in source.even_split_points(ask, T.DecimalType(38, 0), parts)]
        assert points == sorted(set(points)) and len(points) < max(parts, 1)
        sizes = Counter(sum(p <= v for p in points) for v in values)
        hottest = max(Counter(values).values(), default=0)
        assert max(sizes.values(), default=0) <= max(2 * len(values) / parts, hottest + len(values) / parts)
        assert max(asked) <= 60 * parts and len(asked) < 50


def test_an_empty_query_is_read_without_ranges(spark, mixed):
    db, asked = mixed
    empty = source.read_in_ranges(spark, "jdbc:none", "SELECT * FROM t WHERE FALSE", "Id", 20)
    assert empty.isEmpty() and not asked


def test_predicates_take_the_place_of_ranges(spark, mixed):
    db, asked = mixed
    hashed = hash_predicates('"Id"', 3)
    rows = source.QuerySource(
        spark, "jdbc:none", "SELECT * FROM t", "At", "Id", 4, predicates=hashed
    )
    rows.read(None, None, None)
    assert asked == hashed


def test_split_points():
    zoned = source.split_points(
        "2024-01-01 00:00:00.000000 +00:00", "2024-01-03 00:00:00.000000 +00:00", T.TimestampType(), 2
    )
    assert zoned == ["2024-01-02 00:00:00.000000 +00:00"]
    assert source.split_points("3", "5", T.LongType(), 20) == ["3", "4", "5"]
    assert source.split_points("1", "inf", T.DoubleType(), 4) == []
    wide = "9" * 38
    assert source.split_points("-" + wide, wide, T.DecimalType(38, 0), 2) == ["0"]
    with pytest.raises(UnsupportedType):
        source.split_points("a", "b", T.StringType(), 4)


def test_zoneless_times_are_read_as_such():
    assert source._ZONELESS == {"preferTimestampNTZ": "true"}


def test_catalog_names_are_quoted_as_they_are():
    assert source.bounded_query("SELECT 1", "MixedCase", "1").endswith('WHERE "MixedCase" > 1')
    assert '"MixedCase"' in jdbc.insert_statement("t", "s", ["MixedCase"])
    assert 't."Key" = s."Key"' in jdbc.merge_statement("t", "s", ["Key", "v"], ["Key"])


class Statement:
    def __init__(self, log, fails):
        self.log, self.fails = log, fails

    def executeUpdate(self, sql):
        if self.fails:
            raise RuntimeError("constraint violated")
        self.log.append(sql)

    def close(self):
        pass


class Connection:
    def __init__(self, fails=False):
        self.log, self.fails = [], fails

    def setAutoCommit(self, on):
        assert on is False

    def createStatement(self):
        return Statement(self.log, self.fails)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_one_transaction_commits_or_rolls_back():
    good = Connection()
    jdbc.in_one_transaction(good, ["a", "b"])
    assert good.log == ["a", "b", "commit", "close"]
    bad = Connection(fails=True)
    with pytest.raises(RuntimeError):
        jdbc.in_one_transaction(bad, ["a"])
    assert bad.log == ["rollback", "close"]


def test_a_query_becomes_a_subquery():
    assert as_subquery("SELECT id, ts FROM t") == "(SELECT id, ts FROM t) q_"


@pytest.mark.parametrize("splits", [[], ["'m'"], ["'blue'", "'green'", "'red'"]])
def test_range_predicates_give_every_row_once(spark, splits):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet").withColumn(
        "p_name", F.when(F.col("p_size") != 11, F.col("p_name"))
    )
    predicates = range_predicates("p_name", splits)
    assert len(predicates) == len(splits) + 1
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    assert part.where(hits != 1).isEmpty()


def test_hash_predicates_give_every_row_once_nulls_included(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet").withColumn(
        "h", F.when(F.col("p_size") != 11, F.hash("p_name"))
    )
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in hash_predicates("h", 7)), F.lit(0))
    assert part.where(hits != 1).isEmpty()


class DuckConnection:
    """Just enough of a JDBC connection, on DuckDB."""

    def __init__(self, db):
        self.db = db

    def setAutoCommit(self, on):
        self.db.execute("BEGIN")

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        self.db.execute(sql)

    def commit(self):
        self.db.execute("COMMIT")

    def rollback(self):
        self.db.execute("ROLLBACK")

    def close(self):
        pass


@pytest.fixture
def wired(spark, db, monkeypatch):
    """``load_table`` with DuckDB where the database would be; every task writes twice."""

    def read_query(session, url, query, properties):
        result = db.execute(query)
        types = {"INTEGER": "int", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "BIGINT": "long"}
        schema = ", ".join(f"`{d[0]}` {types[str(d[1])]}" for d in result.description)
        return session.createDataFrame(result.fetchall(), schema)

    def write(self, url, table, mode, properties):
        assert mode == "append"
        assert (properties["batchsize"], properties["numPartitions"]) == ("1000", "16")
        names = ", ".join(f'"{c}"' for c in self._df.columns)
        marks = ", ".join("?" for _ in self._df.columns)
        for row in self._df.collect() * 2:
            db.execute(f"INSERT INTO {table} ({names}) VALUES ({marks})", list(row))

    monkeypatch.setattr(jdbc, "read_query", read_query)
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", write)
    return lambda df, keys=(): jdbc.load_table(
        df, "jdbc:none", "sink", keys=keys, connect=lambda *_: DuckConnection(db)
    )


def tables(db):
    return [r[0] for r in db.execute("SELECT table_name FROM information_schema.tables").fetchall()]


def test_load_appends_text_by_the_targets_types(spark, db, wired):
    df = spark.createDataFrame([("2024-02-02 00:00:00", "3")], "ts string, id string")
    assert wired(df) == 1
    assert (3, None, "2024-02-02", None) in found(db)
    assert tables(db) == ["SINK"]


def test_load_upserts(spark, db, wired):
    df = spark.createDataFrame([(2, "z"), (9, "n"), (None, "k")], "Id int, Name string")
    assert wired(df, ["id"]) == 3
    assert [(r[0], r[1]) for r in found(db)] == [(1, "a"), (2, "z"), (9, "n"), (None, "k")]
    assert wired(df.where("Id = 0"), ["id"]) == 0


def test_a_failed_merge_leaves_the_target_and_no_staging(spark, db, wired, monkeypatch):
    before = found(db)
    monkeypatch.setattr(jdbc, "merge_statement", lambda *a: "MERGE INTO nothing")
    with pytest.raises(duckdb.Error):
        wired(spark.createDataFrame([(2, "z")], "id int, name string"), ["id"])
    with pytest.raises(KeyProblem, match="repeat"):
        wired(spark.createDataFrame([(2, "z"), (2, "y")], "id int, name string"), ["id"])
    assert found(db) == before and tables(db) == ["SINK"]


def test_a_sync_from_table_to_table(spark, db, wired, monkeypatch, tmp_path):
    db.execute('CREATE TABLE "ORDERS" ("ID" INTEGER, "NAME" VARCHAR, "TS" TIMESTAMP)')
    read = jdbc.read_query  # the stand-in
    monkeypatch.setattr(source, "read_query", lambda s, url, query, *_: read(s, url, query, {}))
    monkeypatch.setattr(
        source, "read_in_ranges", lambda s, url, query, *_: read(s, url, query, {})
    )
    orders = source.QuerySource(spark, "jdbc:none", 'SELECT * FROM "ORDERS"', "ts", "id", 4)
    state = SyncState(spark, str(tmp_path / "state"))

    def run():
        return sync_to(orders, lambda rows: wired(rows, ["id"]), state, "orders")

    assert run().rows_read == 0 and state.load("orders") is None
    db.execute("INSERT INTO \"ORDERS\" VALUES (2, 'B', '2024-03-01'), (7, 'G', '2024-03-02 10:00:00.5')")
    first = run()
    assert (first.rows_written, first.watermark) == (2, "2024-03-02 10:00:00.500000")
    db.execute("INSERT INTO \"ORDERS\" VALUES (7, 'H', '2024-03-03'), (8, 'I', '2024-02-01')")
    second = run()
    assert (second.resumed_from, second.rows_written) == (first.watermark, 1)
    assert run().rows_read == 0
    assert [(r[0], r[1]) for r in found(db)] == [(1, "a"), (2, "B"), (7, "H")]
