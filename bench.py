"""Time the headline jobs; prints one JSON line.

    BENCH_SF_DIR   folder of the tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores            (default 8)
    BENCH_ONLY     comma-separated jobs   (default: the headline jobs)
    BENCH_RUNS     timed runs per job     (default 3, the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tidemark import storage
from tidemark.plans import extract_jobs
from tidemark.plans.load_jobs import new_target
from tidemark.plans.registry import JOBS
from tidemark.sinks.jsonl import write_json_lines
from tidemark.sources.query import read_table

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "query_scan",
    "wide_full_read",
    "describe_columns",
    "canonical_events",
    "canonical_numbers",
    "decode_strict",
    "lob_text",
    "incr_first_run",
    "incr_resume_ts",
    "incr_resume_id",
    "watermark",
    "chunk_manifest",
    "chunk_manifest_ties",
    "ordered_export",
    "append_atomic",
    "upsert_merge",
    "upsert_partial_columns",
    "upsert_null_key",
    "upsert_by_period",
    "append_duplicate_keys",
    "insert_only_merge",
    "load_report",
    "typed_write",
    "jsonl_roundtrip",
    "number_roundtrip",
    "reconcile_counts",
    "reconcile_bytes",
    "reconcile_ranges",
    "sync_two_runs",
    "stream_upsert",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidemark-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def drain(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def full_read_to_json_lines(spark: SparkSession) -> tuple[int, float]:
    """A query of 34 columns, every row, rendered and written as JSON lines."""
    wide = extract_jobs.wide_query(spark, FOLDER)
    assert len(wide.columns) == 34
    rows = wide.count()
    seconds = [
        timed(
            lambda: write_json_lines(
                wide, storage.new_folder(spark, "bench"), partitions=int(CPUS)
            )
        )
        for _ in range(RUNS)
    ]
    return rows, statistics.median(seconds)


def keyed_upsert(spark: SparkSession) -> tuple[int, float]:
    """``orders``, all of it, upserted by key into a target that already holds it."""
    orders = read_table(spark, FOLDER, "orders")
    rows = orders.count()
    target = new_target(spark, orders.schema, ("o_orderkey",))
    target.append(orders)
    return rows, statistics.median([timed(lambda: target.upsert(orders)) for _ in range(RUNS)])


def main() -> None:
    spark = session()
    chosen = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    drain(read_table(spark, FOLDER, "events"))
    times = {}
    for name in chosen:
        run = JOBS[name].run
        drain(run(spark, FOLDER))  # compile once, outside the timing
        seconds = [timed(lambda: drain(run(spark, FOLDER))) for _ in range(RUNS)]
        times[name] = round(statistics.median(seconds), 3)
    rates = {}
    if chosen is HEADLINE:
        for label, job in (
            ("full_read_to_json_lines", full_read_to_json_lines),
            ("keyed_upsert", keyed_upsert),
        ):
            rows, seconds = job(spark)
            times[label] = round(seconds, 3)
            rates[label] = {"rows": rows, "rows_per_sec": round(rows / seconds)}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": rates,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
