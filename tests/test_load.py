"""Loads: merge semantics, atomicity, checks before writing, retries, streaming."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.errors import (
    ColumnMismatch,
    CommitConflict,
    KeyProblem,
    TidemarkError,
    UnsupportedType,
    VerifyFailed,
)
from tidemark.operators import merge
from tidemark.operators.align import align
from tidemark.operators.chunks import chunk_manifest, with_positions
from tidemark.operators.describe import canonical
from tidemark.operators.key_filter import key_filter, possible_keys, word_count
from tidemark.operators.reconcile import differing_rows
from tidemark.plans import recheck as recheck_module
from tidemark.plans.recheck import differing_folders, recheck
from tidemark.plans.state import SyncState
from tidemark.plans.sync import FrameSource, sync, sync_to
from tidemark.sinks.files import FileTarget
from tidemark.sinks.jsonl import JsonLinesRuns, write_json_lines
from tidemark.streaming.upsert import merge_batch, stream_upsert

SCHEMA = "id int, grp string, v double, note string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_force(target, stage, names, keys):
    """The merge, one row at a time."""
    at = [names.index(k) for k in keys]
    result = [list(r) for r in target]
    by_key = {}
    for r in result:
        key = tuple(r[i] for i in at)
        if None not in key:
            by_key.setdefault(key, []).append(r)
    for staged in stage:
        key = tuple(staged[i] for i in at)
        hits = [] if None in key else by_key.get(key, [])
        for r in hits:
            r[:] = staged
        if not hits:
            result.append(list(staged))
    return sorted((tuple(r) for r in result), key=repr)


@pytest.fixture
def sides(spark):
    rng = random.Random(3)
    # Half the target shares one key, and many rows have none.
    old = [(7, "hot", float(i), "o") for i in range(200)]
    old += [(None, f"g{i % 3}", float(i), "o") for i in range(60)]
    old += [(i, f"g{i % 3}", float(i), None) for i in range(100, 240)]
    new = [(7, "hot", -1.0, None), (None, "g1", -2.0, "n"), (None, "g1", -2.0, "n")]
    new += [(i, f"g{i % 3}", -float(i), rng.choice(["n", None])) for i in range(200, 300)]
    return old, new


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_upsert_equals_row_by_row_merge(spark, sides, threshold):
    old, new = sides
    names = ["id", "grp", "v", "note"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = merge.upsert(
            spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["ID", "grp"]
        )
        assert rows(got) == brute_force(old, new, names, ["id", "grp"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_file_target_equals_row_by_row_merge(spark, tmp_path, sides, threshold):
    old, new = sides
    old = old[199:]  # a target holds a key once
    target = FileTarget.create(
        spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["id", "grp"], 5
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        target.append(spark.createDataFrame(old, SCHEMA))
        report = target.upsert(spark.createDataFrame(new, SCHEMA), ["GRP", "id"])
        expected = brute_force(old, new, ["id", "grp", "v", "note"], ["id", "grp"])
        assert rows(target.read()) == expected
        assert (report.received, report.inserted) == (len(new), len(expected) - len(old))
        assert target.count() == len(expected)
        # Merging the same keyed rows again changes nothing.
        keyed = [r for r in new if r[0] is not None]
        assert target.upsert(spark.createDataFrame(keyed, SCHEMA)).inserted == 0
        assert rows(target.read()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", range(3))
def test_any_sequence_of_loads_equals_the_model(spark, tmp_path, seed):
    rng = random.Random(seed)
    names, keys = ["id", "grp", "v", "note"], ["id", "grp"]
    schema = spark.createDataFrame([], SCHEMA).schema
    target = FileTarget.create(spark, str(tmp_path / "t"), schema, keys, rng.choice([1, 3, 8]))
    model: list = []
    refused = 0

    def some_rows(unique):
        made = {}
        for _ in range(rng.choice([0, 2, 5, 30])):
            key = (rng.choice([None, *range(40)]), rng.choice("abc"))
            row = (*key, float(rng.randrange(9)), rng.choice([None, "n"]))
            if unique and key[0] is not None:
                made[key] = row
            else:
                made[object()] = row
        return list(made.values())

    for _ in range(8):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", rng.choice(["-1", "10MB"]))
        try:
            if rng.random() < 0.5:
                new = some_rows(unique=rng.random() < 0.8)
                held = [r[:2] for r in model + new if r[0] is not None]
                if len(held) > len(set(held)):
                    with pytest.raises(KeyProblem):
                        target.append(spark.createDataFrame(new, SCHEMA))
                    refused += 1
                else:
                    assert target.append(spark.createDataFrame(new, SCHEMA)).received == len(new)
                    model = model + new
            elif rng.random() < 0.2:
                target.pack()
                assert len(target.version().parts) <= 1
            else:
                new = some_rows(unique=True)
                report = target.upsert(spark.createDataFrame(new, SCHEMA))
                merged = brute_force(model, new, names, keys)
                assert report.inserted == len(merged) - len(model)
                model = merged
            assert rows(target.read()) == sorted(model, key=repr)
            assert target.count() == len(model)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_merge_reads_and_shuffles_each_side_once(spark):
    old = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    new = old.where("o_orderdate > TIMESTAMP_NTZ '2001-07-01 00:00:00'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge.merge_rows(old, new, ["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    # Keyed rows of each side; keyless rows, which the scan can skip by its statistics.
    assert plan.count("FileScan") == 4
    assert plan.count("IsNull(o_orderkey)") == 2 and plan.count("IsNotNull(o_orderkey)") == 2


def files_of(target):
    version = target.version()
    return {r[0] for r in target._rows(version).select(target._file_of(version)).distinct().collect()}


def numbers(spark, n):
    return spark.range(n).selectExpr("cast(id AS int) AS id", "'g' AS grp", "1D AS v", "'o' AS note")


def test_only_files_that_hold_a_staged_key_are_rewritten(spark, tmp_path):
    base = numbers(spark, 2000)
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 16)
    target.append(base.where("id < 1000"))
    target.append(base.where("id >= 1000"))
    before = files_of(target)
    report = target.upsert(base.where("id = 5").withColumn("v", F.lit(9.0)))
    assert (report.received, report.inserted, report.updated, report.rewritten) == (1, 0, 1, 1)
    assert len(before - files_of(target)) == 1 and len(files_of(target) - before) == 1
    assert target.read().where("v = 9").select("id").collect()[0][0] == 5
    # Rows the target does not hold rewrite nothing, in the same buckets or not.
    kept = files_of(target)
    report = target.upsert(base.withColumn("id", F.col("id") + 5000))
    assert (report.inserted, report.rewritten) == (2000, 0) and kept < files_of(target)
    assert target.read().count() == target.count() == 4000


def test_rewritten_files_are_not_even_scanned(spark, tmp_path):
    base = numbers(spark, 100)
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 4)
    target.append(base)
    target.upsert(base.where("id = 5").withColumn("v", F.lit(9.0)))
    gone = [name for part in target.version().parts for name in part.gone]
    assert len(gone) == 1
    scan = target.read()
    listed = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    scan.collect()
    assert listed.metrics().apply("numFiles").value() == len(files_of(target))


def test_periods_that_are_not_staged_keep_their_files(spark, tmp_path):
    base = spark.range(600).selectExpr(
        "cast(id AS int) AS id", "date_add(DATE '2024-01-01', cast(id div 100 AS int)) AS day", "0 AS v"
    )
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id", "day"], 3, period="DAY")
    target.append(base)

    def days():
        rows = target._rows(target.version()).select("tm_period", "_metadata.file_path")
        out = {}
        for day, name in rows.distinct().collect():
            out.setdefault(day, set()).add(name)
        return out

    before = days()
    new = base.where("day = DATE '2024-01-03'").unionAll(
        spark.sql("SELECT 9999, DATE '2024-02-01', 1 UNION ALL SELECT 1, NULL, 2 UNION ALL SELECT 1, NULL, 2")
    )
    report = target.upsert(new.withColumn("v", F.col("v") + 7))
    after = days()
    assert (report.inserted, report.updated) == (3, 100)
    assert not before["2024-01-03"] & after["2024-01-03"] and after.keys() - before.keys() == {"2024-02-01", None}
    assert all(after[d] == before[d] for d in before if d != "2024-01-03")
    assert target.read().where("v = 7").count() == 100
    held = target._held(target._placed(base.where("id = 5"), target.version()), target.version())
    scan = held._jdf.queryExecution().executedPlan().toString()
    assert "tm_period" in scan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(KeyProblem, match="period"):
        FileTarget.create(spark, str(tmp_path / "u"), base.schema, ["id"], 3, period="day")


def test_a_key_is_appended_once(spark, tmp_path):
    base = numbers(spark, 300)
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id", "grp"], 4)
    target.append(base)
    version = target.version()
    for again in (base, base.where("id = 7"), base.withColumn("id", F.col("id") + 299)):
        with pytest.raises(KeyProblem, match="in the target"):
            target.append(again)
    twice = base.withColumn("id", F.col("id") + 300)
    with pytest.raises(KeyProblem, match="repeat"):
        target.append(twice.unionAll(twice))
    assert target.version() == version
    assert [len(storage.list_names(spark, str(tmp_path / "t" / d))) for d in ("data", "filters")] == [1, 1]
    # Rows without a full key match nothing, so they may repeat; a key that an upsert moved
    # to another load is found there.
    keyless = base.withColumn("id", F.lit(None).cast("int"))
    target.append(keyless.unionAll(keyless))
    target.append(twice)
    target.upsert(base.where("id < 20"))
    with pytest.raises(KeyProblem, match="in the target"):
        target.append(base.where("id = 19"))
    assert target.count() == target.read().count() == 1200


def test_zeros_of_either_sign_are_one_key(spark, tmp_path):
    target = FileTarget.create(spark, str(tmp_path / "t"), spark.createDataFrame([], "k double, v int").schema, ["k"], 7)
    target.append(spark.createDataFrame([(0.0, 1), (float("nan"), 2)], "k double, v int"))
    with pytest.raises(KeyProblem):
        target.append(spark.createDataFrame([(-0.0, 1)], "k double, v int"))
    assert target.upsert(spark.createDataFrame([(-0.0, 3), (float("nan"), 4)], "k double, v int")).updated == 2
    assert sorted(r["v"] for r in target.read().collect()) == [3, 4]


def test_filters_deny_no_key_and_most_others(spark):
    keys = spark.range(5000).selectExpr("id", "cast(id AS string) AS s")
    words = word_count(5000)
    made = key_filter(keys, ["id", "s"], words)
    assert possible_keys(keys, ["id", "s"], made, words).count() == 5000
    others = spark.range(5000, 25_000).selectExpr("id", "cast(id AS string) AS s")
    assert possible_keys(others, ["id", "s"], made, words).count() < 600


def test_version_file_grows_with_loads_only_and_packing_empties_it(spark, tmp_path):
    base = numbers(spark, 40)
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 64)
    for i in range(6):
        target.append(base.withColumn("id", F.col("id") + 40 * i))
    version = target.version()
    size = len(storage.read_text(spark, target._file(version.number)))
    assert [p.gone for p in version.parts] == [[]] * 6
    assert size < 700 + 6 * 100  # so 200 appends take some 20 kB, whatever the buckets
    files = len(files_of(target))
    before = rows(target.read())
    report = target.pack()
    assert report.received == 0 and rows(target.read()) == before
    assert len(target.version().parts) == 1 and len(files_of(target)) < files
    running = tmp_path / "t" / "data" / "tm_run=r0"
    running.mkdir()
    assert len(target.expire(keep=1)) == 6 and running.exists()
    assert len(storage.list_names(spark, str(tmp_path / "t" / "filters"))) == 1
    assert rows(target.read()) == before and target.expire(keep=1) == []


def test_readers_of_a_version_are_not_disturbed(spark, tmp_path):
    base = spark.range(10).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 2)
    target.append(base)
    before = target.read()
    number = target.version().number
    target.upsert(base.withColumn("v", F.lit(5.0)))
    assert {r["v"] for r in before.collect()} == {0.0}
    assert {r["v"] for r in target.read(number).collect()} == {0.0}
    assert {r["v"] for r in target.read().collect()} == {5.0}


def test_failures_leave_the_target_and_no_data(spark, tmp_path):
    base = spark.range(10).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 2)
    target.append(base)
    before, version = rows(target.read()), target.version()
    data = storage.list_names(spark, str(tmp_path / "t" / "data"))
    bad = base.withColumn("v", F.when(F.col("id") == 7, "?").otherwise("1"))
    fresh = base.withColumn("id", F.col("id") + 100)
    for load in (target.append, target.upsert):
        with pytest.raises(Exception, match=r"column v: cannot read '\?'"):
            load(bad)
        with pytest.raises(VerifyFailed):
            load(fresh, at_least=11)
    with pytest.raises(KeyProblem, match="repeat"):
        target.upsert(base.unionAll(base))
    with pytest.raises(ColumnMismatch):
        target.upsert(base.drop("id"))
    with pytest.raises(ColumnMismatch):
        target.append(base.withColumn("stray", F.lit(1)))
    with pytest.raises(UnsupportedType):
        target.append(base.withColumn("note", F.array("note")))
    with pytest.raises(KeyProblem, match="keyed by"):
        target.upsert(base, ["grp"])
    assert target.version() == version and rows(target.read()) == before
    assert storage.list_names(spark, str(tmp_path / "t" / "data")) == data
    assert storage.list_names(spark, str(tmp_path / "t" / "staging")) == []


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    base = spark.range(10).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema)
    slow = FileTarget(spark, target.root)
    stale = slow.version()
    target.append(base)
    slow.version = lambda number=None: stale
    with pytest.raises(CommitConflict):
        slow.append(base)
    assert target.read().count() == 10
    assert len(storage.list_names(spark, str(tmp_path / "t" / "data"))) == 1


def test_keys_are_checked_before_any_work(spark, tmp_path):
    base = spark.createDataFrame([], SCHEMA)
    unkeyed = FileTarget.create(spark, str(tmp_path / "t"), base.schema)
    with pytest.raises(KeyProblem):
        unkeyed.upsert(base)
    with pytest.raises(KeyProblem):
        merge.upsert(base, base, [])
    with pytest.raises(ColumnMismatch):
        merge.upsert(base, base.select("grp"), ["id"])


def test_missing_columns_keep_or_null(spark):
    old = spark.createDataFrame([(1, "a", 1.0, "x"), (2, "b", 2.0, "y")], SCHEMA)
    new = spark.createDataFrame([(None, 2), ("n", 3)], "Note string, ID int")
    got = rows(merge.upsert(old, new, ["id"]))
    assert got == rows(
        spark.createDataFrame([(1, "a", 1.0, "x"), (2, "b", 2.0, None), (3, None, None, "n")], SCHEMA)
    )


def test_any_column_name_can_be_loaded(spark, tmp_path):
    names = ["weird name", "a.b", 'q"q', "part", "_at", "position", "run", "rows"]
    df = spark.range(20).select(*[(F.col("id") + i).alias(n) for i, n in enumerate(names)])
    target = FileTarget.create(spark, str(tmp_path / "t"), df.schema, ["a.b", "WEIRD NAME".lower()], 3)
    target.append(df)
    target.upsert(df)
    assert rows(target.read()) == rows(df)
    placed = with_positions(df, "a.b", name="at")
    assert placed.columns == ["at", *names]
    assert sorted(r["at"] for r in placed.collect()) == list(range(20))
    assert chunk_manifest(df, "part", 7).count() == 3
    assert differing_rows(df, target.read(), ["a.b"]).isEmpty()
    assert canonical(df).columns == names


def test_the_targets_own_folder_names_are_reserved(spark, tmp_path):
    with pytest.raises(ColumnMismatch):
        FileTarget.create(spark, str(tmp_path / "t"), spark.range(1).toDF("TM_Bucket").schema)


def test_align_rejects_doubles(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    df = spark.createDataFrame([(1, 2)], "x int, y int").toDF("ID", "Id")
    with pytest.raises(ColumnMismatch):
        align(df, schema)


def test_sync_resumes_and_repeats_nothing(spark, tmp_path):
    source = spark.range(100).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), source.schema)
    one = sync(FrameSource(source, "id", upto="49"), target, "s", initial="9")
    assert (one.resumed_from, one.watermark, one.rows_written) == (None, "49", 40)
    two = sync(FrameSource(source, "ID"), target, "s", initial="9")
    assert (two.resumed_from, two.watermark, two.rows_written) == ("49", "99", 50)
    three = sync(FrameSource(source, "id"), target, "s")
    assert (three.rows_read, three.watermark) == (0, "99")
    assert sorted(r["id"] for r in target.read().collect()) == list(range(10, 100))
    # Another sync into the same target has its own watermark.
    assert sync(FrameSource(source.where("id < 3"), "id"), target, "other").rows_written == 3


@pytest.mark.parametrize(
    ("cursor", "stop"),
    [
        ("day", "2024-01-05 00:00:00"),
        ("wall", "2024-01-05 00:00:00.000000"),
        ("instant", "2024-01-05 00:00:00.000000 +00:00"),
        ("price", "4.25"),
        ("ratio", "4.5"),
        ("name", "n04"),
    ],
)
def test_sync_by_every_kind_of_cursor(spark, tmp_path, cursor, stop):
    source = spark.range(12).selectExpr(
        "id",
        "date_add(DATE '2024-01-01', cast(id AS int)) AS day",
        "timestampadd(DAY, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS wall",
        "timestampadd(HOUR, 24 * id, timestamp '2024-01-01 00:00:00 UTC') AS instant",
        "cast(id + 0.25 AS decimal(10, 2)) AS price",
        "cast(id AS double) + 0.5D AS ratio",
        "concat('n', lpad(cast(id AS string), 2, '0')) AS name",
    )
    target = FileTarget.create(spark, str(tmp_path / "t"), source.schema)
    one = sync(FrameSource(source, cursor, upto=stop), target, "s")
    two = sync(FrameSource(source, cursor), target, "s")
    three = sync(FrameSource(source, cursor), target, "s")
    assert (one.rows_written, one.watermark) == (5, stop)
    assert (two.rows_written, two.resumed_from, three.rows_read) == (7, stop, 0)
    assert sorted(r["id"] for r in target.read().collect()) == list(range(12))


def test_sync_to_writes_state_after_the_load(spark, tmp_path):
    source = spark.range(20).selectExpr("id", "id * 2 AS v")
    state = SyncState(spark, str(tmp_path / "state"))
    loaded = []

    def failing(df):
        raise RuntimeError("sink is down")

    def load(df):
        write_json_lines(df, str(tmp_path / f"out{len(loaded)}"), cursor="id")
        loaded.append(sorted(int(r["id"]) for r in spark.read.json(str(tmp_path / f"out{len(loaded)}")).collect()))
        return len(loaded[-1])

    with pytest.raises(RuntimeError):
        sync_to(FrameSource(source, "id"), failing, state, "s")
    assert state.load("s") is None
    sync_to(FrameSource(source.where("id < 15"), "id"), load, state, "s")
    assert state.load("s") == "14"
    report = sync_to(FrameSource(source, "id"), load, state, "s")
    assert loaded == [list(range(15)), list(range(15, 20))]
    assert (report.resumed_from, report.watermark) == ("14", "19")
    with pytest.raises(VerifyFailed):
        sync_to(FrameSource(source, "id"), lambda df: 3, SyncState(spark, str(tmp_path / "n")), "s")


def test_replayed_micro_batches_are_skipped(spark, tmp_path):
    base = spark.range(10).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 2)
    merge_one = merge_batch(target, lambda: "orders/1")
    merge_one(base, 0)
    merge_one(base.unionAll(base).withColumn("v", F.lit(1.0)), 1)
    number = target.version().number
    merge_one(base.withColumn("v", F.lit(9.0)), 1)
    merge_one(base.withColumn("v", F.lit(9.0)), 0)
    assert target.version().number == number
    assert {r["v"] for r in target.read().collect()} == {1.0}


def test_a_stream_continues_and_a_new_checkpoint_starts_over(spark, tmp_path):
    base = spark.range(6).selectExpr("cast(id AS int) AS id", "'g' AS grp", "0D AS v", "'o' AS note")
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 2)
    feed = str(tmp_path / "feed")

    def deliver(v):
        base.withColumn("v", F.lit(v)).coalesce(1).write.mode("append").parquet(feed)

    def run(checkpoint):
        stream = spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(feed)
        stream_upsert(stream, target, "s", str(tmp_path / checkpoint)).awaitTermination()
        return {r["v"] for r in target.read().collect()}

    deliver(1.0)
    assert run("one") == {1.0}
    number = target.version().number
    assert run("one") == {1.0} and target.version().number == number
    deliver(2.0)
    assert run("one") == {2.0}
    assert target.version().number == number + 1
    run("two")
    assert len(target.version().markers) == 2 and target.read().count() == 6


def test_json_lines_have_every_column_and_bounded_files(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "CASE WHEN id < 20 THEN 'x' END AS note", "encode('é', 'utf-8') AS b")
    write_json_lines(df, str(tmp_path / "out"), cursor="id", chunk_rows=10)
    files = sorted((tmp_path / "out").glob("part-*"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert lines[0] == '{"id":"0","note":"x","b":"w6k="}'
    assert lines[-1] == '{"id":"24","note":null,"b":"w6k="}'
    assert max(len(f.read_text().splitlines()) for f in files) <= 10


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, master, setting=None):
        self.sparkContext = FakeContext(master)
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(FakeSession("spark://host", "/shared")) == "/shared"
    assert storage.new_folder(FakeSession("spark://host", "/shared"), "x").startswith("/shared/tidemark/x-")
    local = FakeSession("local[8]")
    assert storage.shared_folder(local) == storage.shared_folder(local)
    assert storage.shared_folder(local) != storage.shared_folder(FakeSession("local[8]"))
    with pytest.raises(TidemarkError, match="spark.checkpoint.dir"):
        storage.shared_folder(FakeSession("spark://host"))
    assert storage.materialize(spark.range(5)).count() == 5


def test_scratch_goes_when_its_owner_is_done(spark, tmp_path):
    def folders():
        found = storage.list_names(spark, storage.os.path.join(storage.shared_folder(spark), "tidemark"))
        return {name for name in found if name.split("-")[0] in ("input", "positions", "chunks", "sync")}

    df = spark.range(40).withColumn("v", F.col("id") % 7)
    before = folders()
    with pytest.raises(RuntimeError), storage.scratch(spark):
        assert with_positions(df, "v").count() == 40 and len(folders()) == len(before) + 2
        raise RuntimeError
    assert folders() == before
    assert write_json_lines(df, str(tmp_path / "out"), cursor="v") == 40
    assert folders() == before
    assert write_json_lines(df, str(tmp_path / "dealt"), partitions=5) == 40
    assert len(list((tmp_path / "dealt").glob("part-*"))) == 5
    with_positions(df, "v")
    assert len(folders()) > len(before)


def test_interrupted_runs_replace_what_they_wrote(spark, tmp_path):
    source = spark.range(30).select("id")
    sink = JsonLinesRuns(str(tmp_path / "out"))
    state = SyncState(spark, str(tmp_path / "state"))

    class Crash(SyncState):
        def save(self, name, watermark):
            raise RuntimeError("after the write")

    early = FrameSource(source.where("id < 12"), "id")
    for _ in range(2):
        with pytest.raises(RuntimeError):
            sync_to(early, sink, Crash(spark, str(tmp_path / "state")), "s")
    # More has arrived when the run is started again.
    assert sync_to(FrameSource(source.where("id < 20"), "id"), sink, state, "s").rows_written == 20
    assert sync_to(FrameSource(source, "id"), sink, state, "s").rows_written == 10
    assert sync_to(FrameSource(source, "id"), sink, state, "s").rows_written == 0
    read = spark.read.json(str(tmp_path / "out" / "*"))
    assert sorted(int(r["id"]) for r in read.collect()) == list(range(30))
    assert len(storage.list_names(spark, str(tmp_path / "out"))) == 2


def test_rows_without_a_cursor_are_loaded_once(spark, tmp_path):
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "c int, v int")
    later = nulls.unionAll(spark.createDataFrame([(5, 3)], "c int, v int"))
    for late_ties in (False, True):
        target = FileTarget.create(spark, str(tmp_path / f"t{late_ties}"), nulls.schema)
        for rows, loaded in ((nulls, 2), (nulls, 0), (later, 1), (later, 0)):
            report = sync(FrameSource(rows, "c", late_ties=late_ties), target, "s")
            assert report.rows_written == loaded
        assert report.watermark == "5" and target.count() == 3


def test_late_ties_are_read_once(spark, tmp_path):
    """Any arrivals at any cursor: what a run reads is new rows past or at the watermark."""
    rng = random.Random(8)
    schema = "c int, v string"
    target = FileTarget.create(spark, str(tmp_path / "t"), spark.createDataFrame([], schema).schema)
    there, loaded, stored = [], [], None
    for _ in range(7):
        high = (stored or 0) + rng.randrange(2)
        arriving = [(rng.choice([high, high, high + 1]), rng.choice(["a", "b", None])) for _ in range(rng.randrange(6))]
        if stored is not None:
            loaded += [r for r in arriving if r[0] >= stored]
        else:
            loaded += arriving
        there += arriving
        rng.shuffle(there)
        report = sync(FrameSource(spark.createDataFrame(there, schema), "c", late_ties=True), target, "s")
        stored = max((r[0] for r in there), default=stored)
        assert rows(target.read()) == sorted(loaded, key=repr)
        assert report.watermark == (None if stored is None else str(stored))
        assert len(storage.list_names(spark, str(tmp_path / "t" / "ties"))) == bool(loaded)


def test_the_last_by_order_wins(spark, tmp_path):
    schema = "id int, seq int, v string"
    empty = spark.createDataFrame([], schema)
    target = FileTarget.create(spark, str(tmp_path / "t"), empty.schema, ["id"], 2)
    merge_one = merge_batch(target, lambda: "s/1", order="SEQ")

    def batch(*given):
        return spark.createDataFrame(list(given), schema).repartition(3)

    merge_one(batch((1, 5, "e"), (1, 7, "g"), (1, 6, "f"), (2, None, "x"), (None, 1, "n"), (None, 1, "n")), 0)
    merge_one(batch((1, 6, "late"), (2, 1, "first"), (3, 3, "three"), (3, 3, "three")), 1)
    merge_one(batch((1, 7, "again"), (2, None, "none"), (3, 4, "four")), 2)
    assert rows(target.read()) == sorted(
        [(1, 7, "again"), (2, 1, "first"), (3, 4, "four"), (None, 1, "n"), (None, 1, "n")], key=repr
    )


def test_conflicting_rows_of_a_batch_need_an_order(spark, tmp_path):
    base = numbers(spark, 10)
    target = FileTarget.create(spark, str(tmp_path / "t"), base.schema, ["id"], 2)
    with pytest.raises(KeyProblem, match="repeat"):
        merge_batch(target, lambda: "s/1")(base.unionAll(base.withColumn("v", F.lit(3.0))), 0)
    assert target.count() == 0


def test_deliveries_are_merged_once_whatever_the_batch(spark, tmp_path):
    schema = "id int, v string, d string"
    target = FileTarget.create(
        spark, str(tmp_path / "t"), spark.createDataFrame([], "id int, v string").schema, ["id"], 2
    )
    feed = str(tmp_path / "feed")

    def run(*given):
        spark.createDataFrame(list(given), schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
        stream_upsert(stream, target, "s", str(tmp_path / "c"), delivery="D").awaitTermination()
        return rows(target.read())

    assert run((None, "a", "1"), (None, "a", "2"), (None, "b", None)) == [(None, "a"), (None, "a"), (None, "b")]
    got = run((None, "a", "1"), (None, "a", "3"), (None, "b", None), (4, "c", "4"))
    assert got == sorted([(None, "a")] * 3 + [(None, "b")] * 2 + [(4, "c")], key=repr)
    assert run((5, "d", "4"), (None, "a", "2")) == got


def test_only_folders_that_differ_are_read_again(spark, tmp_path):
    base = numbers(spark, 400).withColumn("grp", F.concat(F.lit("g "), F.col("id") % 4))
    one, two = (
        FileTarget.create(spark, str(tmp_path / name), base.schema, ["id", "grp"], 4, period="grp")
        for name in ("one", "two")
    )
    assert differing_folders(one, two) == [] and recheck(one, two).isEmpty()
    one.append(base.where("id < 300"))
    one.append(base.where("id >= 300"))
    two.append(base.withColumn("v", F.when(F.col("id") == 8, 5.0).otherwise(F.col("v"))))
    assert len(differing_folders(one, two)) == 1
    found = recheck(one, two)
    assert [(r["id"], r["kind"], r["differing"]) for r in found.collect()] == [(8, "changed", ["v"])]
    # The rows that are compared come from one folder of each side.
    version = two.version()
    place = differing_folders(one, two)
    scan = two._rows(version).where(recheck_module._place(two._layout(version)).isin(place))
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.count() < 60
    scan.collect()
    assert leaf.metrics().apply("numFiles").value() == 1
    # Digests of a load are made once: later checks read the new loads only.
    made = storage.list_names(spark, str(tmp_path / "two" / "digests"))
    two.upsert(base.where("id = 8"))
    assert differing_folders(one, two) == []
    assert len(storage.list_names(spark, str(tmp_path / "two" / "digests"))) == len(made) + 1
    one.upsert(base.where("id = 8").withColumn("id", F.lit(None).cast("int")))
    two.append(base.where("id = 9").withColumn("id", F.lit(7000)))
    kinds = sorted((r["kind"], r["id"]) for r in recheck(one, two).collect() if r["id"] is not None)
    assert kinds == [("extra", 7000)]
    assert {r["kind"] for r in recheck(one, two).collect()} == {"extra", "missing"}
    with pytest.raises(KeyProblem, match="same keys"):
        other = FileTarget.create(spark, str(tmp_path / "x"), base.schema, ["id"], 4)
        recheck(one, other)
