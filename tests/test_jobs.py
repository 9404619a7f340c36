"""Every named job against DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tidemark.plans.registry import JOBS
from tests.compare import assert_same, open_tables

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


def test_every_job_states_its_result():
    assert contract.queries().keys() >= JOBS.keys()
    assert contract.oracle_sql().keys() >= JOBS.keys()


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job(spark, db, name):
    assert_same(contract.queries()[name](spark, FOLDER), db, contract.oracle_sql()[name])


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
