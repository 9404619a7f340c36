"""The named jobs, each next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Job:
    run: Run
    sql: str


JOBS: dict[str, Job] = {}


def job(sql: str) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        JOBS[run.__name__] = Job(run, sql.strip())
        return run

    return register
