"""Any user query as a source."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def query_scan(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """``query`` with ``{name}`` standing for the given frames.

    It stays a plan: projections and filters added later are pushed through it
    to the scans.
    """
    return spark.sql(query, **tables)
