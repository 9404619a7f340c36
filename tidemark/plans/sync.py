"""The incremental sync: stored watermark, bounded extract, load, check, new watermark.

The ceiling is frozen before anything is read. A parallel read has no common
snapshot and a task may read twice; without a ceiling, the stored watermark
could pass rows that were never loaded.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.errors import VerifyFailed
from tidemark.functions.names import ref, resolve
from tidemark.operators.incremental import Frontier, frontier, late_rows, read_past, tied_rows
from tidemark.plans.state import SyncState
from tidemark.sinks.files import FileTarget, LoadReport


class Source(Protocol):
    """What a sync reads from. A bound is the stored watermark, else the initial one."""

    def look_ahead(self, stored: object | None, initial: object | None) -> Frontier:
        """The ceiling of the rows past the bound, and their number."""

    def read(
        self, stored: object | None, initial: object | None, ceiling: str | None
    ) -> DataFrame:
        """The rows past the bound, up to the ceiling."""

    def without_nulls(self) -> Source:
        """The same, without the rows whose cursor is NULL."""


class RunSink(Protocol):
    """A sink that can replace what an interrupted run wrote."""

    def load_run(self, rows: DataFrame, run: str) -> int:
        """Write the rows of the run of this name, and return their number."""


@dataclass(frozen=True)
class FrameSource:
    """A frame with a cursor column; ``upto`` is a ceiling set by the user.

    With ``late_ties``, rows that arrive later with a cursor equal to the watermark are read
    by the next run of :func:`sync`: the hashes of the rows read there are kept.
    """

    rows: DataFrame
    cursor: str
    upto: str | None = None
    late_ties: bool = False

    def _within(self) -> DataFrame:
        return self.rows if self.upto is None else read_past(self.rows, self.cursor, upto=self.upto)

    def look_ahead(self, stored: object | None, initial: object | None) -> Frontier:
        return frontier(self._within(), self.cursor, stored, initial)

    def read(
        self, stored: object | None, initial: object | None, ceiling: str | None
    ) -> DataFrame:
        return read_past(self._within(), self.cursor, stored, initial, ceiling)

    def without_nulls(self) -> FrameSource:
        name = resolve(self.rows.columns, self.cursor)
        return replace(self, rows=self.rows.where(F.col(ref(name)).isNotNull()))


@dataclass(frozen=True)
class SyncReport:
    resumed_from: str | None
    watermark: str | None
    rows_read: int
    rows_written: int
    inserted: int
    updated: int


def sync(
    source: Source,
    target: FileTarget,
    name: str,
    mode: str = "append",
    initial: object | None = None,
) -> SyncReport:
    """One run into a file target, which publishes its watermark with the rows.

    So a run that is interrupted anywhere can simply be started again: nothing
    is lost and nothing is loaded twice, for appends as well as upserts.
    """
    if mode not in ("append", "upsert"):
        raise ValueError(f"mode {mode!r}: use 'append' or 'upsert'")
    load = target.append if mode == "append" else target.upsert
    markers = target.version().markers
    stored = markers.get(name)
    if f"{name}/nulls" in markers:
        source = source.without_nulls()
    if getattr(source, "late_ties", False):
        return _sync_with_ties(source, target, load, name, initial)
    ahead = source.look_ahead(stored, initial)
    if not ahead.rows:
        return SyncReport(stored, stored, 0, 0, 0, 0)
    rows = source.read(stored, initial, ahead.watermark)
    # Rows that move no watermark have a NULL cursor: remember that these are there.
    marker = {f"{name}/nulls": "read"} if ahead.watermark is None else {name: ahead.watermark}
    done = load(rows, markers=marker, at_least=ahead.rows)
    return SyncReport(
        resumed_from=stored,
        watermark=ahead.watermark or stored,
        rows_read=ahead.rows,
        rows_written=done.received,
        inserted=done.inserted,
        updated=done.updated,
    )


def _sync_with_ties(
    source: FrameSource,
    target: FileTarget,
    load: Callable[..., LoadReport],
    name: str,
    initial: object | None,
) -> SyncReport:
    """A run that also reads late rows at the stored watermark.

    The rows are staged first: the hashes kept must be those of the rows that are loaded,
    not of what the source has a moment later. They are a table beside the target, named
    by a marker that is published with the rows.
    """
    spark, marker = target.spark, f"{name}/ties"
    markers = target.version().markers
    stored, known = markers.get(name), markers.get(marker)
    ahead = source.look_ahead(stored, initial)
    with storage.scratch(spark):
        rows = source.read(stored, initial, ahead.watermark or stored)
        seen = None if known is None else spark.read.parquet(target.beside("ties", known))
        if seen is not None:
            rows = rows.unionByName(late_rows(source._within(), source.cursor, stored, seen))
        staged = storage.materialize(rows, "sync")
        count = staged.count()
        if not count:
            return SyncReport(stored, stored, 0, 0, 0, 0)
        watermark = ahead.watermark or stored
        if watermark is None:
            done = load(staged, markers={f"{name}/nulls": "read"}, at_least=count)
            return SyncReport(stored, stored, count, done.received, done.inserted, done.updated)
        ties = tied_rows(staged, source.cursor, watermark)
        if watermark == stored and seen is not None:
            both = ties.unionByName(seen).groupBy("tm_hash_a", "tm_hash_b")
            ties = both.agg(F.sum("copies").alias("copies"))
        run = uuid.uuid4().hex
        ties.write.parquet(target.beside("ties", run))
        try:
            done = load(staged, markers={name: watermark, marker: run}, at_least=count)
        except BaseException:
            storage.remove(spark, target.beside("ties", run))
            raise
    if known is not None:
        storage.remove(spark, target.beside("ties", known))
    return SyncReport(stored, watermark, count, done.received, done.inserted, done.updated)


def sync_to(
    source: Source,
    load: Callable[[DataFrame], int] | RunSink,
    state: SyncState,
    name: str,
    initial: object | None = None,
) -> SyncReport:
    """One run into any other sink; ``load`` returns the rows it received.

    The state is written after the load has committed. A crash in between reads
    the same range again: harmless for an upsert, repeated rows for an append. A sink
    with ``load_run`` is told the run's name, the same for a run that is started again,
    and replaces what it wrote.
    """
    stored = state.load(name)
    ahead = source.look_ahead(stored, initial)
    if not ahead.rows:
        return SyncReport(stored, stored, 0, 0, 0, 0)
    rows = source.read(stored, initial, ahead.watermark)
    if hasattr(load, "load_run"):
        digest = hashlib.sha256(repr((name, stored, initial)).encode()).hexdigest()
        written = load.load_run(rows, f"run-{digest[:16]}")
    else:
        written = load(rows)
    if written < ahead.rows:
        raise VerifyFailed(f"{ahead.rows} rows to read, but {written} were written")
    if ahead.watermark is not None:
        state.save(name, ahead.watermark)
    return SyncReport(stored, ahead.watermark or stored, ahead.rows, written, written, 0)
