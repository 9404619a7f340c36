"""Jobs that read: scans, canonical projection, incremental extract, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.canonical import epoch_text, from_text, to_text
from tidemark.operators.chunks import chunk_manifest as chunk_manifest_of
from tidemark.operators.chunks import with_chunks, with_positions
from tidemark.operators.describe import as_load_text, canonical, profile_columns
from tidemark.operators.incremental import high_watermark, read_past
from tidemark.plans.registry import job
from tidemark.sources.jdbc import (
    Cell,
    even_split_points,
    hash_predicates,
    histogram_query,
    range_predicates,
    sql_literal,
)
from tidemark.sources.query import query_scan as run_query
from tidemark.sources.query import read_table

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


# -- scans and description ---------------------------------------------------------

SCAN = """
SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
FROM {orders} o
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
WHERE o.o_orderstatus = 'F'
"""


@job(SCAN.format(orders="orders", customer="customer", nation="nation"))
def query_scan(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: read_table(spark, folder, name) for name in ("orders", "customer", "nation")}
    return run_query(spark, SCAN, **tables)


@job("""
SELECT * FROM (VALUES
  (0, 'l_orderkey', 'bigint', 'string', (SELECT count(l_orderkey) FROM lineitem)),
  (1, 'l_linenumber', 'int', 'string', (SELECT count(l_linenumber) FROM lineitem)),
  (2, 'l_tax', 'double', 'double', (SELECT count(l_tax) FROM lineitem)),
  (3, 'price', 'decimal(18,2)', 'string', (SELECT count(l_extendedprice) FROM lineitem)),
  (4, 'l_returnflag', 'string', 'string', (SELECT count(l_returnflag) FROM lineitem)),
  (5, 'l_shipdate', 'timestamp_ntz', 'string', (SELECT count(l_shipdate) FROM lineitem)),
  (6, 'ship_day', 'date', 'string', (SELECT count(l_shipdate) FROM lineitem)),
  (7, 'returned', 'boolean', 'boolean', (SELECT count(l_returnflag) FROM lineitem)),
  (8, 'flag_bytes', 'binary', 'binary',
      (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O'))
) AS d(ordinal, name, source_type, canonical_type, values_present)
""")
def describe_columns(spark: SparkSession, folder: str) -> DataFrame:
    described = run_query(
        spark,
        """
        SELECT l_orderkey, l_linenumber, l_tax, cast(l_extendedprice AS decimal(18, 2)) AS price,
               l_returnflag, l_shipdate, cast(l_shipdate AS date) AS ship_day,
               l_returnflag = 'R' AS returned,
               CASE WHEN l_linestatus = 'O' THEN encode(l_linestatus, 'utf-8') END AS flag_bytes
        FROM {lineitem}
        """,
        lineitem=read_table(spark, folder, "lineitem"),
    )
    return profile_columns(described)


WIDE = """
SELECT l.*, o.*, c.*, p.*, s.*, n.n_name AS customer_nation, r.r_name AS customer_region
FROM {lineitem} l
JOIN {orders} o ON o.o_orderkey = l.l_orderkey
JOIN {customer} c ON c.c_custkey = o.o_custkey
JOIN {part} p ON p.p_partkey = l.l_partkey
JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
JOIN {nation} n ON n.n_nationkey = c.c_nationkey
JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""
WIDE_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")
WIDE_TEXT = [
    *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "o_orderkey", "o_custkey"),
    *("c_custkey", "c_nationkey", "p_partkey", "p_size", "s_suppkey", "s_nationkey"),
]


@job(f"""
SELECT * REPLACE (
  {', '.join(f'cast({c} AS varchar) AS {c}' for c in WIDE_TEXT)},
  {TS.format('l_shipdate')} AS l_shipdate, {TS.format('o_orderdate')} AS o_orderdate)
FROM ({WIDE.format(**{t: t for t in WIDE_TABLES})})
""")
def wide_full_read(spark: SparkSession, folder: str) -> DataFrame:
    """34 columns of seven tables, every row, in canonical form."""
    return canonical(wide_query(spark, folder))


def wide_query(spark: SparkSession, folder: str) -> DataFrame:
    tables = {name: read_table(spark, folder, name) for name in WIDE_TABLES}
    return run_query(spark, WIDE, **tables)


# -- canonical projection ----------------------------------------------------------


@job(f"""
SELECT cast(event_id AS varchar) AS event_id, {TS.format('ts')} AS ts,
       cast(user_id AS varchar) AS user_id, event_type, value, props
FROM events
""")
def canonical_events(spark: SparkSession, folder: str) -> DataFrame:
    return canonical(read_table(spark, folder, "events"))


@job("""
SELECT cast(o_orderkey AS varchar) AS o_orderkey,
       strftime(cast(o_orderdate AS date), '%Y-%m-%d %H:%M:%S') AS order_day
FROM orders
""")
def canonical_dates(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return canonical(
        orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
    )


@job(f"""
SELECT cast(event_id AS varchar) AS event_id,
       {TS.format('ts - INTERVAL 2 HOURS')} || ' +00:00' AS happened
FROM events
""")
def canonical_tz(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    local = F.concat(to_text(F.col("ts"), events.schema["ts"].dataType), F.lit(" +02:00"))
    happened = from_text(local, T.TimestampType(), "happened")
    return canonical(events.select("event_id", happened.alias("happened")))


@job("""
SELECT 'event' AS kind, event_id AS id,
       rtrim(rtrim(cast(cast(value AS decimal(18, 6)) AS varchar), '0'), '.') AS plain,
       cast(cast(floor(value) * 10000000 AS bigint) AS varchar) AS large,
       rtrim(rtrim(cast(cast(value AS decimal(18, 2)) AS varchar), '0'), '.') AS exact
FROM events
UNION ALL
SELECT 'part', p_partkey,
       rtrim(rtrim(cast(cast(p_retailprice AS decimal(18, 6)) AS varchar), '0'), '.'),
       cast(cast(floor(p_retailprice) * 10000000 AS bigint) AS varchar),
       rtrim(rtrim(cast(cast(p_retailprice AS decimal(18, 2)) AS varchar), '0'), '.')
FROM part
""")
def canonical_numbers(spark: SparkSession, folder: str) -> DataFrame:
    numbers = run_query(
        spark,
        """
        SELECT 'event' AS kind, event_id AS id, value FROM {events}
        UNION ALL SELECT 'part', p_partkey, p_retailprice FROM {part}
        """,
        events=read_table(spark, folder, "events"),
        part=read_table(spark, folder, "part"),
    ).select(
        "kind",
        "id",
        F.col("value").alias("plain"),
        (F.floor("value").cast("double") * 10000000).alias("large"),
        F.col("value").cast("decimal(18,2)").alias("exact"),
    )
    kind = {f.name: f.dataType for f in numbers.schema}
    texts = [to_text(F.col(c), kind[c], c).alias(c) for c in ("plain", "large", "exact")]
    return numbers.select("kind", "id", *texts)


@job("""
SELECT cast(event_id AS varchar) AS event_id,
       printf('+%02d ', date_diff('day', TIMESTAMP '2024-01-01', ts))
           || strftime(ts, '%H:%M:%S.%f') AS since_start,
       printf(CASE WHEN user_id = 0 THEN '+%02d-%02d' ELSE '-%02d-%02d' END,
              user_id // 12, user_id % 12) AS months_back
FROM events
""")
def canonical_interval(spark: SparkSession, folder: str) -> DataFrame:
    spans = read_table(spark, folder, "events").select(
        "event_id",
        F.expr("ts - TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("since_start"),
        (-F.make_ym_interval(F.lit(0), F.col("user_id").cast("int"))).alias("months_back"),
    )
    return canonical(spans)


@job(f"""
SELECT event_id, {TS.format('ts')} AS from_micros,
       {TS.format("date_trunc('millisecond', ts)")} AS from_millis
FROM events
""")
def epoch_to_text(spark: SparkSession, folder: str) -> DataFrame:
    micros = F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")
    )
    raw = read_table(spark, folder, "events").select("event_id", micros.alias("micros"))
    return raw.select(
        "event_id",
        epoch_text(F.col("micros"), "us").alias("from_micros"),
        epoch_text(F.floor(F.col("micros") / 1000), "ms").alias("from_millis"),
    )


@job("SELECT * FROM events")
def decode_strict(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    text = as_load_text(events)
    return text.select(
        [from_text(F.col(f.name), f.dataType, f.name).alias(f.name) for f in events.schema]
    )


@job("""
SELECT o_orderkey, o_orderstatus <> 'P' AS closed,
       o_orderpriority IN ('1-URGENT', '2-HIGH') AS pressing
FROM orders
""")
def decode_boolean(spark: SparkSession, folder: str) -> DataFrame:
    worded = run_query(
        spark,
        """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN 'TRUE' ELSE 'false' END AS closed,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'true'
                    WHEN o_orderpriority = '2-HIGH' THEN '1'
                    WHEN o_orderpriority = '5-LOW' THEN 'FALSE' ELSE '0' END AS pressing
        FROM {orders}
        """,
        orders=read_table(spark, folder, "orders"),
    )
    return worded.select(
        "o_orderkey",
        from_text(F.col("closed"), T.BooleanType(), "closed").alias("closed"),
        from_text(F.col("pressing"), T.BooleanType(), "pressing").alias("pressing"),
    )


@job("""
SELECT cast(page_id AS varchar) AS page_id, octet_length(encode(html)) AS bytes,
       sha256(html) AS digest
FROM pages
""")
def lob_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = canonical(read_table(spark, folder, "pages"))
    return pages.select(
        "page_id", F.octet_length("html").alias("bytes"), F.sha2("html", 256).alias("digest")
    )


# -- incremental extract -----------------------------------------------------------


@job("SELECT event_id, ts, value FROM events")
def incr_first_run(spark: SparkSession, folder: str) -> DataFrame:
    return read_past(read_table(spark, folder, "events"), "ts").select("event_id", "ts", "value")


@job("SELECT event_id, ts, value FROM events WHERE event_id > 5000")
def incr_initial(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return read_past(events, "event_id", initial="5000").select("event_id", "ts", "value")


@job("SELECT event_id, ts, value FROM events WHERE event_id > 1999")
def incr_resume_id(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return read_past(events, "event_id", resume=1999).select("event_id", "ts", "value")


@job(f"""
SELECT cast(event_id AS varchar) AS event_id, {TS.format('ts')} AS ts,
       cast(user_id AS varchar) AS user_id, event_type, value, props
FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00'
""")
def incr_resume_ts(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return canonical(read_past(events, "ts", resume="2024-01-05 00:00:00.000000"))


@job("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00'")
def incr_precedence(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    past = read_past(
        events, "ts", resume="2024-01-20 12:00:00.000000", initial="2024-01-02 00:00:00.000000"
    )
    return past.select("event_id", "ts")


@job("SELECT event_id, ts FROM events WHERE event_id > 5000")
def incr_case_fold(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return read_past(events, "EVENT_ID", initial="5000").select("event_id", "ts")


@job("SELECT p_partkey, p_name FROM part WHERE p_name > 'red'")
def incr_text_cursor(spark: SparkSession, folder: str) -> DataFrame:
    return read_past(read_table(spark, folder, "part"), "p_name", resume="red").select(
        "p_partkey", "p_name"
    )


@job("SELECT page_id, url FROM pages WHERE url > 'http://o''brien'")
def incr_text_quoted(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    return read_past(pages, "url", resume="http://o'brien").select("page_id", "url")


@job("""
SELECT o_orderkey, o_totalprice FROM orders WHERE cast(o_totalprice AS decimal(18, 2)) > 99999.99
""")
def incr_decimal_cursor(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").withColumn(
        "price", F.col("o_totalprice").cast("decimal(18,2)")
    )
    return read_past(orders, "price", resume="99999.99").select("o_orderkey", "o_totalprice")


@job(f"""
SELECT 'event_id' AS cursor_name, cast(max(event_id) AS varchar) AS watermark FROM events
UNION ALL SELECT 'ts', {TS.format('max(ts)')} FROM events
UNION ALL SELECT 'p_name', max(p_name) FROM part
UNION ALL SELECT 'order_day', strftime(max(cast(o_orderdate AS date)), '%Y-%m-%d %H:%M:%S')
          FROM orders
UNION ALL SELECT 'price', rtrim(rtrim(cast(max(cast(l_extendedprice AS decimal(18, 2))) AS varchar), '0'), '.')
          FROM lineitem
UNION ALL SELECT 'html_bytes', NULL
""")
def watermark(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    cursors = [
        (events, "event_id"),
        (events, "ts"),
        (read_table(spark, folder, "part"), "p_name"),
        (
            read_table(spark, folder, "orders").select(
                F.col("o_orderdate").cast("date").alias("order_day")
            ),
            "order_day",
        ),
        (
            read_table(spark, folder, "lineitem").select(
                F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
            ),
            "price",
        ),
        (
            read_table(spark, folder, "pages").select(
                F.encode("html", "UTF-8").alias("html_bytes")
            ),
            "html_bytes",
        ),
    ]
    marks = [
        high_watermark(df, name).select(F.lit(name).alias("cursor_name"), "watermark")
        for df, name in cursors
    ]
    result = marks[0]
    for mark in marks[1:]:
        result = result.unionByName(mark)
    return result


@job(f"""
SELECT {TS.format('max(ts)')} AS watermark FROM events WHERE event_type <> 'error'
""")
def watermark_null_cursor(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").withColumn(
        "ts", F.when(F.col("event_type") != "error", F.col("ts"))
    )
    return high_watermark(events, "ts")


# -- chunks and order --------------------------------------------------------------


@job("""
SELECT chunk, count(*) AS rows, cast(max(event_id) AS varchar) AS watermark
FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 2000 AS chunk FROM events)
GROUP BY chunk
""")
def chunk_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_manifest_of(read_table(spark, folder, "events"), "event_id", 2000)


@job(f"""
SELECT chunk, count(*) AS rows, {TS.format('max(l_shipdate)')} AS watermark
FROM (SELECT l_shipdate, (row_number() OVER (ORDER BY l_shipdate) - 1) // 1000 AS chunk
      FROM lineitem)
GROUP BY chunk
""")
def chunk_manifest_ties(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_manifest_of(read_table(spark, folder, "lineitem"), "l_shipdate")


@job(f"""
SELECT chunk, rows, {TS.format('max(high) OVER (ORDER BY chunk)')} AS watermark
FROM (SELECT chunk, count(*) AS rows, max(ts) AS high
      FROM (SELECT ts, (row_number() OVER (ORDER BY ts NULLS LAST) - 1) // 700 AS chunk
            FROM (SELECT CASE WHEN event_type <> 'view' THEN ts END AS ts FROM events))
      GROUP BY chunk)
""")
def chunk_manifest_nulls(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").withColumn(
        "ts", F.when(F.col("event_type") != "view", F.col("ts"))
    )
    return chunk_manifest_of(events, "ts", 700)


@job(f"""
SELECT row_number() OVER (ORDER BY ts) - 1 AS position, cast(event_id AS varchar) AS event_id,
       {TS.format('ts')} AS ts, value
FROM events
""")
def ordered_export(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    placed = with_positions(events, "ts", stable_input=True)
    return canonical(placed).withColumn("position", F.col("position").cast("long"))


@job("""
SELECT (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS chunk, event_id, ts, value
FROM events
""")
def chunked_handout(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    return with_chunks(events, "event_id", stable_input=True)


# -- partitioned database reads ----------------------------------------------------


@job("""
SELECT split, 8 AS parts, count(*) AS rows, count(*) AS rows_read_once, true AS even
FROM lineitem, (VALUES ('decimal'), ('time'), ('bunched'), ('hash')) AS s(split) GROUP BY split
""")
def jdbc_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The predicates of partitioned reads, run over a table: every row is in one of them, and
    the largest part has at most twice the rows of the mean, also where most values are bunched."""
    lineitem = read_table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").alias("shipped"),
        F.expr(
            "CASE WHEN l_linenumber <= 4 THEN l_partkey % 50 ELSE l_orderkey * 1000000 END"
        ).alias("bunched"),
        "l_orderkey",
    )

    def counted(split: str, predicates: list[str]) -> DataFrame:
        hits = F.array_compact(
            F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
        )
        parts = lineitem.select(hits.alias("hits")).groupBy("hits").agg(F.count("*").alias("rows"))
        return parts.agg(
            F.lit(split).alias("split"),
            F.lit(len(predicates)).alias("parts"),
            F.sum("rows").alias("rows"),
            F.sum(F.when(F.size("hits") == 1, F.col("rows"))).alias("rows_read_once"),
            (F.max("rows") <= 2 * F.sum("rows") / len(predicates)).alias("even"),
        )

    def by_ranges(split: str, column: str) -> DataFrame:
        kind = lineitem.schema[column].dataType

        def literal(text: str) -> str:
            return sql_literal(text, kind, column).replace("TIMESTAMP '", "TIMESTAMP_NTZ '")

        def ask(cuts: list[str]) -> list[Cell]:
            query = histogram_query("{rows}", column, [literal(cut) for cut in cuts])
            found = spark.sql(query, rows=lineitem)
            ends = [to_text(F.col(c), kind, column) for c in ("lo_", "hi_")]
            return [Cell(*row) for row in found.select(*ends, "n_").collect()]

        splits = [literal(point) for point in even_split_points(ask, kind, 8)]
        return counted(split, range_predicates(column, splits))

    return (
        by_ranges("decimal", "price")
        .unionByName(by_ranges("time", "shipped"))
        .unionByName(by_ranges("bunched", "bunched"))
        .unionByName(counted("hash", hash_predicates("l_orderkey", 8)))
    )
