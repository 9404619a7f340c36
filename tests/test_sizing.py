from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import sizing, storage

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


def test_sizes_come_from_the_leaves(spark):
    lineitem = spark.read.parquet(LINEITEM)
    size = sizing.scanned_bytes(lineitem)
    joined = lineitem.join(lineitem.select("l_orderkey").distinct(), "l_orderkey")
    assert 0 < size < 10_000_000
    assert sizing.scanned_bytes(joined) == 2 * size


def test_unknown_sizes_do_not_count(spark):
    local = spark.createDataFrame([(1,)], "a int")
    assert sizing.scanned_bytes(local) == 0
    assert sizing.scanned_bytes(spark.createDataFrame([], "a int")) == 0
    assert sizing.scanned_bytes(spark.createDataFrame(local.rdd, "a int")) == 0


def test_large_inputs_raise_the_number_of_partitions(spark, monkeypatch):
    lineitem = spark.read.parquet(LINEITEM)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert sizing.wanted_partitions(spark, lineitem) == int(before)
    monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 50_000)
    wanted = sizing.wanted_partitions(spark, lineitem)
    assert wanted > int(before)
    ranged = sizing.range_partitioned(lineitem, [lineitem["l_orderkey"]])
    assert ranged.rdd.getNumPartitions() == wanted
    with sizing.sized_shuffles(spark, lineitem):
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(wanted)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(sizing, "BYTES_PER_PARTITION", 1)
    assert sizing.wanted_partitions(spark, lineitem) == sizing.scanned_bytes(lineitem)  # no cap


def test_shuffles_of_a_table_go_when_it_is_written(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with sizing.shuffles_removed(spark):
        assert spark.conf.get(setting) == "true"
        table = storage.materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert spark.conf.get(setting) == before
    assert sorted(r["count"] for r in table.collect()) == [14] * 5 + [15] * 2


def test_stages_of_the_pipeline_hand_on_few_texts_at_once(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    import corpus_pipeline

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    texts = spark.range(0, 2000, 1, 1).selectExpr("repeat('x', 5000) AS text")
    texts.write.parquet(str(tmp_path / "documents.parquet"))

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([b.num_rows for b in batches], pa.int64())], names=["n"])

    stage = lambda spark, docs, folder: docs.coalesce(1).mapInArrow(sizes, "n long")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", stage)])
    found = [r["n"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(found) == 2000 and max(found) * 5000 < 5 << 20
    assert spark.conf.get(name, None) == before
