"""Loading a database table: parallel staging, then one transaction.

Spark's JDBC write commits per partition, so it cannot be all-or-nothing on the
target itself. Rows go to a staging table of this run first; one INSERT or MERGE
on a single connection then moves them, and commits or rolls back as a whole.

A task that ran twice (lost executor, speculation) leaves its rows in staging
twice. Each staged row therefore carries a number fixed before the write, and
the final statement takes one row per number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.errors import VerifyFailed
from tidemark.functions.names import quote_exact, quote_path
from tidemark.operators.align import align
from tidemark.operators.merge import merge_keys, require_unique_keys
from tidemark.sources.jdbc import read_query

ROW_NUMBER = "TM_ROW_"


def staging_name(target: str) -> str:
    """A table of this run only, next to the target. 30 bytes at most."""
    parts = target.split(".")
    return ".".join([*parts[:-1], f"TM_STG_{uuid.uuid4().hex[:16].upper()}"])


def staging_statement(target: str, staging: str) -> str:
    """A staging table with the target's own column types, and the row number."""
    return (
        f"CREATE TABLE {quote_path(staging)} AS SELECT t.*, "
        f"CAST(NULL AS DECIMAL(19)) {quote_exact(ROW_NUMBER)} "
        f"FROM {quote_path(target)} t WHERE 1 = 0"
    )


def staged_rows(staging: str, columns: Sequence[str]) -> str:
    """The staged rows, each once however often its task ran."""
    listed = ", ".join(quote_exact(c) for c in columns)
    number = quote_exact(ROW_NUMBER)
    return (
        f"SELECT {listed} FROM (SELECT {listed}, ROW_NUMBER() OVER "
        f"(PARTITION BY {number} ORDER BY {number}) \"TM_COPY_\" FROM {quote_path(staging)}) d_ "
        f'WHERE "TM_COPY_" = 1'
    )


def insert_statement(target: str, staging: str, columns: Sequence[str]) -> str:
    listed = ", ".join(quote_exact(c) for c in columns)
    return f"INSERT INTO {quote_path(target)} ({listed}) {staged_rows(staging, columns)}"


def merge_statement(
    target: str, staging: str, columns: Sequence[str], keys: Sequence[str]
) -> str:
    """One set-based MERGE; with nothing but keys it only inserts."""
    keys = merge_keys(list(columns), list(keys))
    changing = [f"{quote_exact(c)} = s.{quote_exact(c)}" for c in columns if c not in keys]
    clauses = [
        f"MERGE INTO {quote_path(target)} t USING ({staged_rows(staging, columns)}) s",
        "ON (" + " AND ".join(f"t.{quote_exact(k)} = s.{quote_exact(k)}" for k in keys) + ")",
    ]
    if changing:
        clauses.append("WHEN MATCHED THEN UPDATE SET " + ", ".join(changing))
    clauses.append(
        "WHEN NOT MATCHED THEN INSERT ("
        + ", ".join(quote_exact(c) for c in columns)
        + ") VALUES ("
        + ", ".join(f"s.{quote_exact(c)}" for c in columns)
        + ")"
    )
    return " ".join(clauses)


def open_connection(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A driver-side connection. Describing the target has already loaded the JDBC driver."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    return jvm.java.sql.DriverManager.getConnection(url, settings)


def in_one_transaction(connection, statements: Sequence[str]) -> None:
    """All statements, then COMMIT; any failure rolls back."""
    try:
        connection.setAutoCommit(False)
        for sql in statements:
            statement = connection.createStatement()
            statement.executeUpdate(sql)
            statement.close()
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def load_table(
    df: DataFrame,
    url: str,
    target: str,
    properties: Mapping[str, str] | None = None,
    keys: Sequence[str] = (),
    batch_rows: int = 1000,
    connections: int = 16,
    connect: Callable = open_connection,
) -> int:
    """Append, or upsert when ``keys`` are given; returns the rows received.

    At most ``connections`` tasks write to the database at a time, ``batch_rows`` rows
    per statement.
    """
    spark, properties = df.sparkSession, dict(properties or {})
    described = read_query(spark, url, f"SELECT * FROM {quote_path(target)}", properties).schema
    aligned = align(df, described)
    if keys:
        merge_keys(aligned.columns, list(keys))

    # Written once, so that row numbers and rows are the same whenever a task reruns.
    stage = storage.materialize(
        aligned.withColumn(ROW_NUMBER, F.monotonically_increasing_id()), "jdbc-stage"
    )
    received = stage.count()
    if not received:
        return 0
    if keys:
        require_unique_keys(stage, list(keys))

    staging = staging_name(target)
    in_one_transaction(connect(spark, url, properties), [staging_statement(target, staging)])
    try:
        stage.write.jdbc(
            url,
            quote_path(staging),
            mode="append",
            properties={
                **properties,
                "batchsize": str(batch_rows),
                "numPartitions": str(connections),
            },
        )
        distinct = f'SELECT COUNT(DISTINCT {quote_exact(ROW_NUMBER)}) "N" FROM {quote_path(staging)}'
        arrived = int(read_query(spark, url, distinct, properties).first()[0])
        if arrived != received:
            raise VerifyFailed(f"{received} rows staged, but {arrived} arrived")
        if keys:
            final = merge_statement(target, staging, aligned.columns, keys)
        else:
            final = insert_statement(target, staging, aligned.columns)
        in_one_transaction(connect(spark, url, properties), [final])
    finally:
        drop = f"DROP TABLE {quote_path(staging)}"
        in_one_transaction(connect(spark, url, properties), [drop])
    return received
