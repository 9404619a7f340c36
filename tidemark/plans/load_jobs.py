"""Jobs that write: append, upsert, sync, stream, export; and the checks of a copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.errors import KeyProblem
from tidemark.functions.canonical import from_text, to_text
from tidemark.operators import merge, reconcile
from tidemark.operators.align import align, append
from tidemark.operators.describe import as_load_text, canonical_schema
from tidemark.plans.recheck import recheck
from tidemark.plans.registry import job
from tidemark.plans.state import SyncState
from tidemark.plans.sync import FrameSource, sync, sync_to
from tidemark.sinks.files import FileTarget
from tidemark.sinks.jsonl import JsonLinesRuns, write_json_lines
from tidemark.sources.query import read_table
from tidemark.streaming.upsert import stream_upsert as start_stream

BUCKETS = 8

# The target holds the orders known before 2000; the staged rows are a later delivery
# that reaches back a year, with new prices.
TARGET = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'"
STAGE = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
"""
UPSERTED = """
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
       coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate,
       coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
"""


def _target(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'")


def _stage(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.where("o_orderdate >= TIMESTAMP_NTZ '1999-01-01 00:00:00'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )


def new_target(
    spark: SparkSession,
    schema: T.StructType,
    keys: tuple[str, ...] = (),
    period: str | None = None,
) -> FileTarget:
    root = storage.new_folder(spark, "target")
    # A month of these orders is one bucket.
    target = FileTarget.create(spark, root, schema, keys, 1 if period else BUCKETS, period)
    storage.remove_at_exit(spark, root)
    return target


# -- append ------------------------------------------------------------------------


@job(f"""
{TARGET}
UNION ALL
SELECT o_orderkey, NULL, NULL, o_totalprice + 1, o_orderdate, NULL
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
""")
def append_atomic(spark: SparkSession, folder: str) -> DataFrame:
    old = _target(spark, folder)
    target = new_target(spark, old.schema)
    target.append(old)
    target.append(_stage(spark, folder).select("o_totalprice", "o_orderdate", "o_orderkey"))
    return target.read()


@job("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier
""")
def append_by_name(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_name").alias("C_NAME"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.col("s_suppkey").alias("C_CustKey"),
    )
    return append(read_table(spark, folder, "customer"), suppliers)


@job("SELECT * FROM orders")
def align_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    shuffled = orders.select(
        [F.col(c).alias(c.upper() if i % 2 else c.title()) for i, c in enumerate(orders.columns)][
            ::-1
        ]
    )
    return align(shuffled, orders.schema)


@job("SELECT * FROM events")
def typed_write(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    target = new_target(spark, events.schema)
    target.append(as_load_text(events))
    return target.read()


@job("SELECT * FROM orders")
def load_empty(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    nothing = orders.where("o_orderdate < TIMESTAMP_NTZ '1900-01-01 00:00:00'")
    target = new_target(spark, orders.schema, ("o_orderkey",))
    target.append(orders)
    target.append(nothing)
    target.upsert(nothing)
    return target.read()


@job("SELECT * FROM orders")
def abort_leaves_target(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    target = new_target(spark, orders.schema, ("o_orderkey",))
    target.append(orders)
    unreadable = orders.withColumn(
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", F.lit("12,50")).otherwise(
            F.col("o_totalprice").cast("string")
        ),
    )
    for load in (target.append, target.upsert):
        try:
            load(unreadable)
        except Exception as error:  # noqa: BLE001 - a failed load is the point
            if "column o_totalprice: cannot read '12,50'" not in str(error):
                raise
        else:
            raise AssertionError("unreadable numbers were loaded")
    return target.read()


# -- upsert ------------------------------------------------------------------------


@job(f"WITH t AS ({TARGET}), s AS ({STAGE}) {UPSERTED}")
def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    old = _target(spark, folder)
    target = new_target(spark, old.schema, ("o_orderkey",))
    target.append(old)
    target.upsert(_stage(spark, folder))
    return target.read()


@job(f"""
WITH t AS ({TARGET}), s AS ({STAGE})
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey AS o_custkey,
       coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
       t.o_orderdate AS o_orderdate, t.o_orderpriority AS o_orderpriority
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_partial_columns(spark: SparkSession, folder: str) -> DataFrame:
    stage = _stage(spark, folder).select("o_totalprice", "o_orderkey", "o_orderstatus")
    return merge.upsert(_target(spark, folder), stage, ["o_orderkey"])


@job(f"""
WITH t AS ({TARGET}), s AS ({STAGE})
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
       coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus
            WHEN s.o_orderstatus <> 'F' THEN s.o_orderstatus END AS o_orderstatus,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
       coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate,
       coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_null_values(spark: SparkSession, folder: str) -> DataFrame:
    stage = _stage(spark, folder).withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    )
    return merge.upsert(_target(spark, folder), stage, ["o_orderkey"])


NULL_KEYS = {
    "t": "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END",
    "s": "CASE WHEN o_orderpriority < '4' THEN o_orderkey END",
}


@job(f"""
WITH t AS (SELECT {NULL_KEYS['t']} AS k, o_custkey, o_totalprice FROM ({TARGET})),
     s AS (SELECT {NULL_KEYS['s']} AS k, o_custkey, o_totalprice FROM ({STAGE}))
SELECT coalesce(t.k, s.k) AS k, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
FROM t FULL JOIN s ON t.k = s.k
""")
def upsert_null_key(spark: SparkSession, folder: str) -> DataFrame:
    old, new = (
        df.select(F.expr(NULL_KEYS[side]).alias("k"), "o_custkey", "o_totalprice")
        for side, df in (("t", _target(spark, folder)), ("s", _stage(spark, folder)))
    )
    target = new_target(spark, old.schema, ("k",))
    target.append(old)
    target.upsert(new)
    return target.read()


@job(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS o_month, * FROM (WITH t AS ({TARGET}), s AS ({STAGE}) {UPSERTED})
""")
def upsert_by_period(spark: SparkSession, folder: str) -> DataFrame:
    """The month of an order is part of its key: only months that are delivered are read."""
    old, new = (
        df.select(F.date_format("o_orderdate", "yyyy-MM").alias("o_month"), "*")
        for df in (_target(spark, folder), _stage(spark, folder))
    )
    target = new_target(spark, old.schema, ("o_month", "o_orderkey"), period="o_month")
    target.append(old)
    target.upsert(new)
    return target.read()


@job(f"""
SELECT o_orderkey, o_totalprice FROM ({TARGET})
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
""")
def append_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A key is stored once: deliveries that repeat one are refused, whole, and leave no trace."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    old = _target(spark, folder).select("o_orderkey", "o_totalprice")
    later = _stage(spark, folder).where("o_orderdate >= TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    new = later.select("o_orderkey", F.col("o_totalprice") - 1)
    target = new_target(spark, old.schema, ("o_orderkey",))
    target.append(old)
    one = orders.orderBy(F.desc("o_orderkey")).limit(1)
    for repeated in (_stage(spark, folder).select(old.columns), old, one.unionAll(one)):
        try:
            target.append(repeated)
        except KeyProblem:
            continue
        raise AssertionError("a key was stored twice")
    target.append(new.toDF(*old.columns))
    return target.read()


@job("""
SELECT conv_id, turn, role, CASE WHEN role <> 'system' THEN role || ': ' || text ELSE text END AS text
FROM conversations
""")
def upsert_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    talk = read_table(spark, folder, "conversations")
    asked = talk.where("role <> 'assistant'")
    spoken = talk.where("role <> 'system'").withColumn(
        "text", F.concat("role", F.lit(": "), "text")
    )
    return merge.upsert(asked, spoken, ["CONV_ID", "Turn"])


@job("""
SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01'
UNION
SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
""")
def insert_only_merge(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    pairs = ["l_partkey", "l_suppkey"]
    old = lineitem.where("l_shipdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'").select(pairs)
    new = lineitem.where("l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'").select(pairs)
    return merge.upsert(old.distinct(), new.distinct(), pairs)


@job("""
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
WHERE l_returnflag <> 'R' GROUP BY ALL HAVING count(*) > 1
""")
def upsert_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    )
    return merge.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])


@job(f"""
WITH t AS ({TARGET}), s AS ({STAGE}),
     hits AS (SELECT count(*) AS n FROM t JOIN s ON t.o_orderkey = s.o_orderkey)
SELECT (SELECT count(*) FROM s) AS received,
       (SELECT count(*) FROM s) - (SELECT n FROM hits) AS inserted,
       (SELECT n FROM hits) AS updated,
       (SELECT count(*) FROM t) - (SELECT n FROM hits) AS kept
""")
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    return merge.load_report(_target(spark, folder), _stage(spark, folder), ["o_orderkey"])


# -- sync and stream ---------------------------------------------------------------

STOP = "2024-01-15 00:00:00.000000"


@job("SELECT * FROM events")
def sync_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    target = new_target(spark, events.schema, ("event_id",))
    sync(FrameSource(events, "ts", upto=STOP), target, "events", mode="upsert")
    sync(FrameSource(events, "ts"), target, "events", mode="upsert")
    return target.read()


@job("""
SELECT 1 AS run, NULL AS resumed_from, count(*) AS rows_read, count(*) AS rows_written,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark
FROM events WHERE ts <= TIMESTAMP '2024-01-15'
UNION ALL
SELECT 2, strftime(max(ts) FILTER (ts <= TIMESTAMP '2024-01-15'), '%Y-%m-%d %H:%M:%S.%f'),
       count(*) FILTER (ts > TIMESTAMP '2024-01-15'), count(*) FILTER (ts > TIMESTAMP '2024-01-15'),
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')
FROM events
UNION ALL
SELECT 3, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), 0, 0,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f')
FROM events
""")
def sync_reports(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    target = new_target(spark, events.schema)
    reports = [
        sync(FrameSource(events, "ts", upto=STOP), target, "events"),
        sync(FrameSource(events, "ts"), target, "events"),
        sync(FrameSource(events, "ts"), target, "events"),
    ]
    return spark.createDataFrame(
        [
            (i, r.resumed_from, r.rows_read, r.rows_written, r.watermark)
            for i, r in enumerate(reports, 1)
        ],
        "run int, resumed_from string, rows_read long, rows_written long, watermark string",
    )


@job("""
SELECT event_id, date_trunc('day', ts) AS day, copy FROM events, (VALUES (1), (2)) AS c(copy)
WHERE (date_trunc('day', ts) > TIMESTAMP '2024-01-10' AND copy = 1)
   OR (date_trunc('day', ts) = TIMESTAMP '2024-01-10')
   OR (date_trunc('day', ts) < TIMESTAMP '2024-01-10' AND event_type <> 'view' AND copy = 1)
""")
def incr_late_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Runs by day. After the first, which sees no views, rows of its last day arrive late, one
    of each two equal rows among them: they are read once, rows of days before are not."""
    events = read_table(spark, folder, "events").select(
        "event_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type"
    )
    last = F.col("day") == F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    rows = events.drop("event_type")
    twice = rows.unionByName(rows.where(last))
    target = new_target(spark, rows.schema)
    early = events.where("event_type <> 'view'").drop("event_type")
    for seen, upto in ((early, "2024-01-10 00:00:00.000000"), (twice, None), (twice, None)):
        sync(FrameSource(seen, "day", upto=upto, late_ties=True), target, "events")
    nth = Window.partitionBy("event_id").orderBy("day")
    return target.read().withColumn("copy", F.row_number().over(nth))


@job(f"WITH t AS ({TARGET}), s AS ({STAGE}) {UPSERTED}")
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    old = _target(spark, folder)
    target = new_target(spark, old.schema, ("o_orderkey",))
    target.append(old)
    # Deliveries that overlap by half a year; an order has the same values in each.
    feed = storage.new_folder(spark, "feed")
    for start, end in (("1999-01", "2000-01"), ("1999-07", "2001-01"), ("2000-07", "2099-01")):
        _stage(spark, folder).where(
            f"o_orderdate >= TIMESTAMP_NTZ '{start}-01 00:00:00' "
            f"AND o_orderdate < TIMESTAMP_NTZ '{end}-01 00:00:00'"
        ).write.mode("append").parquet(feed)
    storage.remove_at_exit(spark, feed)
    files = [n for n in storage.list_names(spark, feed) if n.endswith(".parquet")]
    stream = (
        spark.readStream.schema(old.schema)
        .option("maxFilesPerTrigger", max(1, len(files) // 3))
        .parquet(feed)
    )
    checkpoint = storage.new_folder(spark, "stream")
    start_stream(stream, target, "orders", checkpoint).awaitTermination()
    return target.read()


@job(f"""
WITH t AS (SELECT {NULL_KEYS['t']} AS k, o_custkey, o_totalprice FROM ({TARGET})),
     s AS (SELECT {NULL_KEYS['s']} AS k, o_custkey, o_totalprice FROM ({STAGE}))
SELECT coalesce(t.k, s.k) AS k, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice
FROM t FULL JOIN s ON t.k = s.k
UNION ALL SELECT k, o_custkey, o_totalprice FROM s WHERE k IS NULL
""")
def stream_upsert_null_key(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that delivers every row twice: keyed rows merge, keyless ones are all inserted."""
    old, new = (
        df.select(F.expr(NULL_KEYS[side]).alias("k"), "o_custkey", "o_totalprice")
        for side, df in (("t", _target(spark, folder)), ("s", _stage(spark, folder)))
    )
    target = new_target(spark, old.schema, ("k",))
    target.append(old)
    feed = storage.new_folder(spark, "feed")
    new.unionByName(new).repartition(6, "o_custkey").write.parquet(feed)
    storage.remove_at_exit(spark, feed)
    stream = (
        spark.readStream.schema(old.schema).option("maxFilesPerTrigger", 2).parquet(feed)
    )
    checkpoint = storage.new_folder(spark, "stream")
    start_stream(stream, target, "orders", checkpoint).awaitTermination()
    return target.read()


@job(f"""
WITH t AS (SELECT {NULL_KEYS['t']} AS k, o_custkey, o_totalprice, 0 AS seq FROM ({TARGET})),
     s AS (SELECT {NULL_KEYS['s']} AS k, o_custkey, o_totalprice + n AS o_totalprice, n AS seq
           FROM ({STAGE}), (VALUES (1), (2), (3)) AS v(n)),
     last AS (SELECT * FROM s WHERE seq = 3 AND k IS NOT NULL)
SELECT coalesce(t.k, last.k) AS k, coalesce(last.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(last.o_totalprice, t.o_totalprice) AS o_totalprice, coalesce(last.seq, t.seq) AS seq
FROM t FULL JOIN last ON t.k = last.k
UNION ALL SELECT k, o_custkey, o_totalprice, seq FROM s WHERE k IS NULL
""")
def stream_upsert_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """Three changes of every row, out of order within a batch and across batches, the first
    batch delivered twice: the last change wins, and rows without a key are there once."""
    old, new = (
        df.select(F.expr(NULL_KEYS[side]).alias("k"), "o_custkey", "o_totalprice", "o_orderkey")
        for side, df in (("t", _target(spark, folder)), ("s", _stage(spark, folder)))
    )
    old = old.drop("o_orderkey").withColumn("seq", F.lit(0))
    target = new_target(spark, old.schema, ("k",))
    target.append(old)
    change = F.explode(F.array(*[F.lit(n) for n in (1, 2, 3)]))
    changes = new.withColumn("seq", change).select(
        "k", "o_custkey", (F.col("o_totalprice") + F.col("seq")).alias("o_totalprice"), "seq",
        F.concat_ws("/", "o_orderkey", "seq").alias("delivery"),
    )
    # Of an order one change comes early, the last or the first; two come in one batch.
    early = (F.col("seq") == 3) == (F.col("o_custkey") % 2 == 0)
    feed = storage.new_folder(spark, "feed")
    batches = [changes.where(early), changes.where(~early), changes.where(early)]
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{feed}/batch={i}")
    storage.remove_at_exit(spark, feed)
    stream = (
        spark.readStream.schema(changes.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{feed}/*")
    )
    checkpoint = storage.new_folder(spark, "stream")
    start_stream(
        stream, target, "orders", checkpoint, order="seq", delivery="delivery"
    ).awaitTermination()
    return target.read()


# -- export and round trips --------------------------------------------------------


def _read_json(spark: SparkSession, schema: T.StructType, folder: str) -> DataFrame:
    """Exported lines; a torn one stops the job."""
    return spark.read.schema(canonical_schema(schema)).json(folder, mode="FAILFAST")


@job("SELECT * FROM lineitem")
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = read_table(spark, folder, "lineitem")
    out = storage.new_folder(spark, "jsonl")
    write_json_lines(lineitem, out)
    storage.remove_at_exit(spark, out)
    text = _read_json(spark, lineitem.schema, out)
    return align(text, lineitem.schema)


@job(f"""
SELECT cast(event_id AS varchar) AS event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
FROM events
""")
def jsonl_ordered_export(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "ts", "value")
    out = storage.new_folder(spark, "jsonl")
    write_json_lines(events, out, cursor="ts", chunk_rows=2000, stable_input=True)
    storage.remove_at_exit(spark, out)
    return _read_json(spark, events.schema, out)


@job(f"""
SELECT CASE WHEN ts <= TIMESTAMP '2024-01-15' THEN 'run 1' ELSE 'run 2' END AS run,
       cast(event_id AS varchar) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
       cast(user_id AS varchar) AS user_id, event_type, value, props
FROM events WHERE ts > TIMESTAMP '2024-01-03 12:00:00'
""")
def jsonl_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into JSON lines, with the watermark in a state folder."""
    events = read_table(spark, folder, "events")
    out = storage.new_folder(spark, "jsonl")
    state = SyncState(spark, storage.new_folder(spark, "state"))
    sink = JsonLinesRuns(out)
    start = "2024-01-03 12:00:00"
    first = FrameSource(events, "ts", upto=STOP)
    # The first run is interrupted after its write: started again, it replaces what it wrote.
    interrupted = SyncState(spark, storage.new_folder(spark, "state"))
    sync_to(first, sink, interrupted, "events", initial=start)
    sync_to(first, sink, state, "events", initial=start)
    written = storage.list_names(spark, out)
    sync_to(FrameSource(events, "TS"), sink, state, "events", initial=start)
    storage.remove_at_exit(spark, out)
    runs = [
        _read_json(spark, events.schema, f"{out}/{run}").select(
            F.lit("run 1" if run in written else "run 2").alias("run"), "*"
        )
        for run in storage.list_names(spark, out)
    ]
    return runs[0].unionByName(runs[1])


def _body(empty: str = "es", missing: str = "fr") -> Column:
    """Bytes of a document: empty in one language, missing in another."""
    lang, text = F.col("lang"), F.encode("text", "UTF-8")
    return F.when(lang == empty, F.encode(F.lit(""), "UTF-8")).when(lang != missing, text)


@job("""
SELECT doc_id, octet_length(encode(body)) AS bytes, sha256(body) AS digest
FROM (SELECT doc_id, CASE lang WHEN 'es' THEN '' WHEN 'fr' THEN NULL ELSE text END AS body
      FROM documents)
""")
def binary_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes, no bytes (an empty value) and no value at all come back as they are."""
    documents = read_table(spark, folder, "documents").select("doc_id", _body().alias("body"))
    target = new_target(spark, documents.schema, ("doc_id",))
    target.upsert(documents)
    return target.read().select(
        "doc_id", F.octet_length("body").alias("bytes"), F.sha2("body", 256).alias("digest")
    )


@job("""
SELECT count(*) AS rows,
       count(*) FILTER (cast(cast(price AS varchar) AS decimal(18, 2)) IS DISTINCT FROM price)
         AS price_mismatches,
       count(*) FILTER (cast(cast(l_tax AS varchar) AS double) IS DISTINCT FROM l_tax)
         AS tax_mismatches,
       sum(price) AS total
FROM (SELECT cast(l_extendedprice AS decimal(18, 2)) AS price, l_tax FROM lineitem)
""")
def number_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    numbers = read_table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_tax"
    )
    kinds = {f.name: f.dataType for f in numbers.schema}
    again = numbers.select(
        "*",
        *[
            from_text(to_text(F.col(c), kind, c), kind, c).alias(f"{c}_again")
            for c, kind in kinds.items()
        ],
    )
    return again.agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("price").eqNullSafe(F.col("price_again"))).alias("price_mismatches"),
        F.count_if(~F.col("l_tax").eqNullSafe(F.col("l_tax_again"))).alias("tax_mismatches"),
        F.sum("price_again").alias("total"),
    )


# -- checks of a copy --------------------------------------------------------------


@job("""
SELECT 'copied' AS copy, count(*) AS rows_read, count(*) AS rows_written, true AS same_content
FROM events
UNION ALL
SELECT 'one value changed', count(*), count(*), false FROM events
UNION ALL
SELECT 'errors lost', count(*), count(*) FILTER (event_type <> 'error'), false FROM events
""")
def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    target = new_target(spark, events.schema, ("event_id",))
    target.append(events)
    copy = target.read()
    last = F.col("event_id") == F.lit(copy.agg(F.max("event_id")).first()[0])
    copies = {
        "copied": copy,
        "one value changed": copy.withColumn(
            "value", F.when(last, F.col("value") + 1).otherwise(F.col("value"))
        ),
        "errors lost": copy.where("event_type <> 'error'"),
    }
    parts = [
        reconcile.reconcile_counts(events, df).select(F.lit(name).alias("copy"), "*")
        for name, df in copies.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@job("""
SELECT doc_id, 'missing' AS kind, NULL AS differing FROM documents WHERE lang = 'fr'
UNION ALL SELECT doc_id, 'changed', 'text,body' FROM documents WHERE lang = 'de'
UNION ALL SELECT doc_id, 'changed', 'body' FROM documents WHERE lang = 'es'
""")
def reconcile_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Also where bytes are empty on one side and missing on the other, or missing on both."""
    documents = read_table(spark, folder, "documents").select(
        "doc_id", "lang", "text", _body(missing="en").alias("body")
    )
    spoiled = F.concat(F.col("text"), F.lit(" "))
    copy = documents.where("lang <> 'fr'").select(
        "doc_id",
        "lang",
        F.when(F.col("lang") == "de", spoiled).otherwise(F.col("text")).alias("text"),
        F.when(F.col("lang") == "de", F.encode(spoiled, "UTF-8"))
        .when(F.col("lang") != "es", F.col("body"))
        .alias("body"),
    )
    found = reconcile.differing_rows(documents, copy, ["doc_id"])
    return found.withColumn("differing", F.array_join("differing", ","))


@job("""
SELECT 'first' AS seen, 'changed' AS kind, o_orderkey, 'o_totalprice' AS differing FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'
UNION ALL
SELECT 'first', 'missing', o_orderkey, NULL FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-11'
UNION ALL
SELECT 'after mending', 'missing', o_orderkey, NULL FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1998-11'
""")
def reconcile_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """A copy with a month changed and one lost, checked; the change is mended, checked again."""
    orders = read_table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("o_month"), "o_orderkey", "o_totalprice"
    )
    month, price = F.col("o_month"), F.col("o_totalprice")
    keys = ("o_month", "o_orderkey")
    source, copy = (new_target(spark, orders.schema, keys, period="o_month") for _ in range(2))
    source.append(orders)
    spoiled = F.when(month == "1997-03", price + 1).otherwise(price)
    copy.append(orders.where(month != "1998-11").withColumn("o_totalprice", spoiled))
    first = recheck(source, copy)
    found = [first.select(F.lit("first").alias("seen"), "*")]
    copy.upsert(orders.where(month == "1997-03"))
    found.append(recheck(source, copy).select(F.lit("after mending").alias("seen"), "*"))
    both = found[0].unionByName(found[1]).drop("o_month")
    return both.withColumn("differing", F.array_join("differing", ","))


@job("""
SELECT 'wider' AS copy, count(*) AS rows_read, count(*) AS rows_written, true AS same_content,
       0 AS changed FROM lineitem
UNION ALL
SELECT 'wider, some changed', count(*), count(*), false,
       count(DISTINCT l_orderkey) FILTER (l_linenumber = 7) FROM lineitem
""")
def reconcile_widened_types(spark: SparkSession, folder: str) -> DataFrame:
    """A copy in wider types, and with its numbers as text, is equal; a changed value shows."""
    lineitem = read_table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), "l_shipdate",
    )
    wider = lineitem.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.col("price").cast("decimal(20,4)").alias("price"), "l_shipdate",
    )
    copies = {
        "wider": wider,
        "wider, some changed": wider.withColumn(
            "price", F.when(F.col("l_linenumber") == 7, -F.col("price")).otherwise(F.col("price"))
        ),
    }
    found = []
    for name, copy in copies.items():
        changed = reconcile.differing_rows(lineitem, copy, ["l_orderkey"]).agg(
            F.count("*").alias("changed")
        )
        found.append(
            reconcile.reconcile_counts(lineitem, copy)
            .unionByName(changed, allowMissingColumns=True)
            .agg(*[F.max(c).alias(c) for c in ("rows_read", "rows_written", "same_content", "changed")])
            .select(F.lit(name).alias("copy"), "*")
        )
    return found[0].unionByName(found[1])


@job("""
SELECT 'changed' AS kind, 'l_tax' AS column_name, count(*) AS keys
FROM (SELECT DISTINCT l_orderkey FROM lineitem
      GROUP BY l_orderkey HAVING bool_or(l_returnflag = 'A'))
""")
def reconcile_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with many rows on both sides: compared as multisets, without pairing rows."""
    lineitem = read_table(spark, folder, "lineitem")
    copy = lineitem.withColumn(
        "l_tax", F.when(F.col("l_returnflag") == "A", F.lit(0.5)).otherwise(F.col("l_tax"))
    )
    return reconcile.mismatch_counts(
        lineitem, copy, ["l_orderkey"], ["l_tax", "l_extendedprice"]
    ).withColumnRenamed("column", "column_name")


@job("""
SELECT ordinal, name, source_type, copy_type, verdict, source_values, copy_values
FROM (VALUES
  (0, 'o_orderkey', 'bigint', 'bigint', 'same', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders)),
  (1, 'o_custkey', 'bigint', 'bigint', 'same', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders)),
  (2, 'o_orderstatus', 'string', 'string', 'same', (SELECT count(*) FROM orders),
      (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F')),
  (3, 'o_totalprice', 'double', 'decimal(18,2)', 'type differs', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders)),
  (4, 'o_orderdate', 'timestamp_ntz', 'timestamp_ntz', 'same', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders)),
  (5, 'o_orderpriority', 'string', NULL, 'missing', (SELECT count(*) FROM orders), NULL),
  (6, 'loaded', NULL, 'boolean', 'extra', NULL, (SELECT count(*) FROM orders))
) AS d(ordinal, name, source_type, copy_type, verdict, source_values, copy_values)
""")
def reconcile_schema(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    copy = orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        "o_orderdate",
        F.lit(True).alias("loaded"),
    )
    return reconcile.reconcile_schema(orders, copy)
