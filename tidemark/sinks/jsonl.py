"""Export to JSON lines, one object per row with every column present."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators.chunks import in_cursor_order
from tidemark.operators.describe import canonical


def write_json_lines(
    df: DataFrame,
    folder: str,
    cursor: str | None = None,
    chunk_rows: int | None = None,
    stable_input: bool = False,
    partitions: int | None = None,
    overwrite: bool = False,
) -> int:
    """Canonical rows as JSON lines; NULLs are written, bytes become base64. Returns their number.

    With ``cursor``, file by file in cursor order; with ``chunk_rows``, no file
    holds more rows than that. A load needs neither. ``partitions`` deals rows that come in
    few splits, as from one small file, out to so many tasks.
    """
    seen = Observation()
    with storage.scratch(df.sparkSession):
        if cursor:
            df = in_cursor_order(df, cursor, stable_input)
        elif partitions:
            df = df.repartition(partitions)
        rows = canonical(df).observe(seen, F.count("*").alias("rows"))
        writer = rows.write.option("ignoreNullFields", False)
        if chunk_rows:
            writer = writer.option("maxRecordsPerFile", max(1, chunk_rows))
        writer.mode("overwrite" if overwrite else "errorifexists").json(folder)
    return seen.get["rows"] or 0


@dataclass(frozen=True)
class JsonLinesRuns:
    """A sink of syncs: a folder a run, named by where the run resumed.

    A run that was interrupted after its write and before its watermark was stored resumes
    at the same place, so it replaces what it wrote.
    """

    folder: str
    partitions: int | None = None

    def load_run(self, rows: DataFrame, run: str) -> int:
        return write_json_lines(
            rows, os.path.join(self.folder, run), partitions=self.partitions, overwrite=True
        )
