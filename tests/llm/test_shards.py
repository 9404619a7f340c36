from __future__ import annotations

import zlib
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, frame
from tidemark.llm import shards


def bytes_of(row):
    return len((row[1] or "").encode()) + 16


def test_awkward_rows(spark):
    result = [tuple(r) for r in shards.shard_digest(frame(spark)).collect()]
    expected = Counter((r[0], bytes_of(r), zlib.crc32((r[1] or "").encode())) for r in documents())
    assert Counter(r[:3] for r in result) == expected
    by_shard = {}
    for row in result:
        assert row[3] == "bytes" and 0 <= row[4] < 40 and row[6] is None
        by_shard.setdefault(row[4], []).append(row[5])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_empty_table(spark):
    assert shards.shard_digest(frame(spark, [])).collect() == []


@pytest.mark.parametrize("copies", [0, 700])
def test_near_equal_bytes(spark, copies):
    """Also when a third of the rows are copies of one text."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 6000")
    if copies:
        copied = spark.range(copies).select(
            (F.col("id") + 10**6).alias("doc_id"), F.lit("copied text " * 200).alias("text"),
            F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.lit(2400).alias("n_chars"),
        )
        docs = docs.unionByName(copied)
    result = shards.kd_shards(docs, ["n_chars", "lang", "source"], shards=8)
    sizes = [r["b"] for r in result.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    mean = sum(sizes) / 8
    assert len(sizes) == 8 and max(abs(s - mean) for s in sizes) < max(6000, 0.03 * mean)


def test_equal_texts_stay_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("source", F.lit("one")).withColumn("lang", F.lit("en"))
    result = shards.kd_shards(docs, ["n_chars"], target_bytes=400_000).join(
        docs.select("doc_id", "text"), "doc_id"
    )
    spread = result.groupBy("text").agg(F.count_distinct("shard").alias("n"), F.sum("size").alias("b"))
    assert spread.where("n > 1 AND b < 400000 / 50").count() == 0


def test_copies_from_other_sources_stay_together(spark):
    """Along the registered dimensions; also where a few rows fill a shard."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )
    copied = docs.where("doc_id % 4 = 0").select(
        F.col("doc_id") + 10**6, "text", F.lit("xx"), F.concat(F.lit("other"), F.col("doc_id") % 9), "n_chars"
    )
    docs = docs.union(copied)
    result = shards.shard_digest(docs).join(docs.select("doc_id", "text"), "doc_id")
    total = result.agg(F.sum("size").alias("b"), F.max("size").alias("row")).first()
    spread = result.groupBy("text").agg(
        F.count("*").alias("copies"), F.count_distinct("shard").alias("n"), F.sum("size").alias("b")
    )
    light = spread.where("copies > 1").where(F.col("b") <= min(total["row"], total["b"] / 40 / 4))
    assert light.count() > 200 and light.where("n > 1").count() == 0


DIMENSIONS = "doc_id long, text string, score double, seen timestamp, day date, wall timestamp_ntz, price decimal(20,6), big long"


def test_any_number_or_time_is_a_dimension(spark):
    """Scores between 0 and 1, microseconds, huge and missing numbers: each in its own order."""
    rows = [
        (i, f"text {i}", i / 500, datetime(2024, 1, 1) + timedelta(microseconds=i), date(2000, 1, 1) + timedelta(days=i),
         datetime(1, 1, 1) + timedelta(hours=i), Decimal(i) / 1000, 2**62 - i * 2**40)
        for i in range(500)
    ]
    odd = [float("nan"), float("inf"), -float("inf"), 1e30, -1e308, 1e308, None]
    rows += [(1000 + i, "odd", x, None, None, None, None, None) for i, x in enumerate(odd)]
    docs = spark.createDataFrame(rows, DIMENSIONS)
    plain = docs.where("doc_id < 1000")
    for name in ("score", "seen", "day", "wall", "price", "big"):
        shard = {r["doc_id"]: r["shard"] for r in shards.kd_shards(plain, [name], shards=4).collect()}
        in_order = [shard[i] for i in range(500)]
        assert in_order == sorted(in_order, reverse=name == "big")
        assert max(Counter(in_order).values()) < 140
        assert shards.kd_shards(docs, [name], shards=4).count() == 507
    values = docs.select("doc_id", shards._values(docs, ["score"])[0].alias("v")).collect()
    odd = {r["doc_id"]: r["v"] for r in values if r["doc_id"] >= 1000}
    assert odd[1000] == odd[1006] == odd[1002] == odd[1004] == 0 and odd[1001] == odd[1005] == 2**32 - 1
    none = docs.where("doc_id >= 1000 AND doc_id < 1003")
    assert shards.kd_shards(none, ["score", "seen"], shards=2).count() == 3


def brute_shards(rows, leaves):
    """The tree over one dimension: cut where the bytes below come nearest to the share."""
    if leaves == 1:
        return [rows]
    total, half = sum(size for _, size in rows), leaves // 2
    sums = [0]
    for _, size in rows:
        sums.append(sums[-1] + size)
    cut = min(range(len(sums)), key=lambda k: abs(sums[k] - total * half / leaves))
    return brute_shards(rows[:cut], half) + brute_shards(rows[cut:], leaves - half)


@pytest.mark.parametrize("leaves", [2, 5, 8])
def test_the_tree_is_that_of_brute_force(spark, leaves):
    rows = [(i, "x" * (i * 37 % 211 + 1) + str(i), float(i)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at double")
    got = {}
    for r in shards.kd_shards(docs, ["at"], shards=leaves, tolerance=0).collect():
        got.setdefault(r["shard"], set()).add(r["doc_id"])
    want = brute_shards([(i, len(text) + 16) for i, text, _ in rows], leaves)
    assert [got[k] for k in range(leaves)] == [{i for i, _ in part} for part in want]


def test_few_jobs_at_the_driver(spark):
    """A level of the tree costs a few jobs; none of them broadcasts its cuts."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), (F.col("id") * 37 % 211).cast("int")).alias("text"),
        F.concat(F.lit("l"), F.col("id") % 3).alias("lang"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"),
        (F.col("id") * 37 % 211 * 3).alias("n_chars"),
    )
    context = spark.sparkContext
    context.setJobGroup("few jobs", "few jobs")
    try:
        rows = shards.shard_digest(docs)
        jobs = len(context.statusTracker().getJobIdsForGroup("few jobs"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert rows.select("shard").distinct().count() == 40
    assert jobs < 100


def passes(search, rows, tolerance, ends):
    """The number of passes that find the cut; ``ends`` are those of a bin's rows, or the bin's own."""
    n = 0
    while search.cut is None:
        low, step, bins = search.low, search.step, {}
        for at, size in rows:
            if low <= at <= search.high:
                k = (at - low) // step
                b, first, last = bins.get(k, (0, at, at))
                bins[k] = b + size, min(first, at), max(last, at)
        if not ends:
            bins = {k: (b, low + k * step, low + (k + 1) * step - 1) for k, (b, _, _) in bins.items()}
        search.narrowed(bins, tolerance)
        n += 1
    return n


@pytest.mark.parametrize("tolerance", [0, 0.001])
def test_bins_known_without_a_pass_give_the_same_cut(tolerance):
    """Rows at a few far values, told apart by the bits below only."""
    draw = Random(9)
    for leaves in (2, 3, 40):
        values = [draw.randrange(1 << 32) for _ in range(4)]
        rows = [(draw.choice(values) << 31 | draw.getrandbits(31), draw.randrange(16, 9000)) for _ in range(2000)]
        size, ats = sum(b for _, b in rows), [at for at, _ in rows]
        fast, plain = (
            shards._Search(0, leaves, 0, min(ats), max(ats), size * (leaves // 2) / leaves, size) for _ in range(2)
        )
        fewer, all_ = passes(fast, rows, tolerance, True), passes(plain, rows, tolerance, False)
        assert fast.cut == plain.cut and fewer < all_


def test_no_python_in_the_plan(spark):
    plan = shards.shard_digest(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
