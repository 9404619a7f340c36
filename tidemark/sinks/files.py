"""A Parquet target that is loaded all-or-nothing.

Data is written to a folder of its own; a small version file naming the live
folders is then published in one step. Until that step, and after any failure,
readers see the previous version.

A keyed target holds a key once, as a table with a primary key does. It is divided
into buckets of its key and, if one of its key columns is named as period, by that
column. A load looks only at the periods and buckets its keys fall in; Bloom filters
kept beside the data then leave the keys that may be there already, and a join with
the target's key columns finds the files they are in. An append stops if there are
any; an upsert rewrites those files and no others.

    <root>/versions/00000012.json     the published versions
    <root>/data/tm_run=<id>/...       rows of one load (tm_period=<p>/tm_bucket=<n>/ if keyed)
    <root>/filters/tm_run=<id>/       Bloom filter of the load's keys
    <root>/staging/<id>               staged rows of a running upsert
    <root>/digests/tm_run=<id>/       rows and sums of row hashes of the load's files
    <root>/ties/<id>                  hashes of the rows a sync read at its watermark
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.errors import (
    ColumnMismatch,
    CommitConflict,
    KeyProblem,
    TidemarkError,
    VerifyFailed,
)
from tidemark.functions.names import ref, resolve_all
from tidemark.operators.align import align
from tidemark.operators.key_filter import key_filter, key_values, possible_keys, word_count
from tidemark.operators.merge import (
    INSERTED,
    SIDE,
    UPDATED,
    has_key,
    merge_keys,
    merge_rows,
    require_unique_keys,
)
from tidemark.operators.reconcile import PIECES, row_hash_pieces
from tidemark.sizing import sized_shuffles

RUN, PERIOD, BUCKET = "tm_run", "tm_period", "tm_bucket"
_FILE = "_metadata"


@dataclass(frozen=True)
class Part:
    """One load: its data files, those whose rows later loads have rewritten (by their path
    below the data folder), and the words of its key filter (0: it holds no full key)."""

    run: str
    files: int
    words: int = 0
    gone: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Version:
    number: int
    schema: str
    keys: list[str] = field(default_factory=list)
    period: str | None = None
    buckets: int = 0
    rows: int = 0
    parts: list[Part] = field(default_factory=list)
    # Per sync or stream: the last position loaded, published with the rows.
    markers: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class LoadReport:
    """``received`` counts the rows handed over, not the rows changed; ``rewritten`` the
    files of the target that held a key of theirs."""

    received: int
    inserted: int
    updated: int
    version: int
    rewritten: int = 0


@dataclass(frozen=True)
class _Loaded:
    version: Version
    received: int = 0
    inserted: int = 0
    rewritten: int = 0


class FileTarget:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    # -- versions ----------------------------------------------------------------

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str] = (),
        buckets: int = 64,
        period: str | None = None,
    ) -> FileTarget:
        """An empty target. ``keys`` make it upsertable; choose ``buckets`` so that one
        bucket of the grown target (of one period, if it has a ``period``) is a few GB.
        ``period`` is a key column of few values that a row never changes, like its month."""
        target = cls(spark, root)
        reserved = {RUN, PERIOD, BUCKET, SIDE, _FILE}
        if taken := reserved & {name.lower() for name in schema.names}:
            raise ColumnMismatch(f"a target cannot have columns named {sorted(taken)}")
        keys = resolve_all(schema.names, keys)
        if period is not None:
            period = resolve_all(schema.names, [period])[0]
            if period not in keys:
                raise KeyProblem(f"the period {period!r} is not one of the keys {keys}")
        buckets = max(1, buckets) if keys else 0
        target._publish(Version(1, schema.json(), keys, period, buckets))
        return target

    def _folder(self, run: str) -> str:
        return os.path.join(self.root, "data", f"{RUN}={run}")

    def beside(self, kind: str, name: str) -> str:
        """A folder beside the data, for what a load of this name keeps."""
        return os.path.join(self.root, kind, name)

    def _filter(self, run: str) -> str:
        return self.beside("filters", f"{RUN}={run}")

    def _file(self, number: int) -> str:
        return os.path.join(self.root, "versions", f"{number:08d}.json")

    def version(self, number: int | None = None) -> Version:
        if number is None:
            names = storage.list_names(self.spark, os.path.join(self.root, "versions"))
            numbers = [int(n[:-5]) for n in names if n.endswith(".json") and n[0] != "."]
            if not numbers:
                raise TidemarkError(f"no target at {self.root}")
            number = max(numbers)
        values = json.loads(storage.read_text(self.spark, self._file(number)))
        values["parts"] = [Part(**p) for p in values["parts"]]
        return Version(**values)

    def _publish(self, version: Version) -> None:
        storage.publish_text(self.spark, self._file(version.number), json.dumps(asdict(version)))

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.version().schema))

    # -- reading -----------------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        version = self.version(number)
        return self._rows(version).select([ref(name) for name in self._schema(version).names])

    @staticmethod
    def _schema(version: Version) -> T.StructType:
        return T.StructType.fromJson(json.loads(version.schema))

    def _layout(self, version: Version) -> list[str]:
        """The folders' columns below a run, outermost first."""
        return [PERIOD] * bool(version.period) + [BUCKET] * bool(version.buckets)

    def _stored(self, version: Version) -> T.StructType:
        """The schema with the folders' columns."""
        stored = self._schema(version).add(RUN, T.StringType())
        for name in self._layout(version):
            stored = stored.add(name, T.IntegerType() if name == BUCKET else T.StringType())
        return stored

    def _rows(self, version: Version) -> DataFrame:
        """The live rows; files that were rewritten are left out when files are listed."""
        paths = [self._folder(part.run) for part in version.parts]
        if not paths:
            return self.spark.createDataFrame([], self._stored(version))
        rows = (
            self.spark.read.schema(self._stored(version))
            .option("basePath", os.path.join(self.root, "data"))
            .parquet(*paths)
        )
        gone = [name for part in version.parts for name in part.gone]
        return rows.where(~self._file_of(version).isin(gone)) if gone else rows

    def _file_of(self, version: Version) -> Column:
        """The path of a row's file below the data folder; known when files are listed."""
        path = F.col(f"{_FILE}.file_path")
        return F.substring_index(path, "/", -(2 + len(self._layout(version))))

    def count(self) -> int:
        """Rows of the newest version, from the version file."""
        return self.version().rows

    def digests(self) -> DataFrame:
        """Rows, and sums of row hashes (see ``operators.reconcile``), of each folder of the
        newest version. Files never change, so theirs are kept beside the data: only loads
        that were not digested yet are read."""
        version, layout = self.version(), self._layout(self.version())
        sums = [f"sum_{i}" for i in PIECES]
        folders = []
        for part in version.parts:
            folder = self.beside("digests", f"{RUN}={part.run}")
            folders.append(folder)
            if "_SUCCESS" not in storage.list_names(self.spark, folder):
                rows = self._rows(replace(version, parts=[replace(part, gone=[])]))
                hashed = row_hash_pieces(rows, self._schema(version).names)
                rows.groupBy(*layout, self._file_of(version).alias("file")).agg(
                    F.count("*").alias("rows"), *[F.sum(h).alias(c) for h, c in zip(hashed, sums)]
                ).write.mode("overwrite").parquet(folder)
        if not folders:
            none = self._rows(version).select(*layout, F.lit(0).alias("rows"))
            return none.select("*", *[F.lit(0).alias(c) for c in sums])
        gone = [name for part in version.parts for name in part.gone]
        kept = self.spark.read.parquet(*folders).where(~F.col("file").isin(gone))
        return kept.groupBy(*layout).agg(*[F.sum(c).alias(c) for c in ["rows", *sums]])

    # -- writing -----------------------------------------------------------------

    def _bucket(self, version: Version) -> Column:
        """Bucket of the key; rows without a full key never match, so they are spread."""
        schema = self._schema(version)
        keys = F.xxhash64(*key_values(schema, version.keys))
        anything = F.xxhash64(*[F.col(ref(c)) for c in schema.names])
        chosen = F.when(has_key(version.keys), keys).otherwise(anything)
        return F.pmod(chosen, F.lit(version.buckets)).cast("int")

    def _placed(self, rows: DataFrame, version: Version) -> DataFrame:
        """Rows of the target's schema with the columns of their folders."""
        if version.buckets:
            rows = rows.withColumn(BUCKET, self._bucket(version))
        if version.period:
            rows = rows.withColumn(PERIOD, F.col(ref(version.period)).cast("string"))
        return rows

    def _write(
        self, rows: DataFrame, version: Version, run: str, **counts: Column
    ) -> dict[str, int]:
        """Write rows of a load, and return ``counts`` and their number, ``rows``.

        They are observed above the last exchange, in the tasks that write: only the
        attempt that is committed counts, whatever ran twice. The exchange is a rebalance,
        so AQE cuts an oversized bucket into several files and puts small ones together.
        """
        layout, seen = self._layout(version), Observation()
        placed = self._placed(rows, version)
        if layout:
            placed = placed.hint("rebalance", *layout)
        counts = {"rows": F.count("*"), **counts}
        observed = placed.observe(seen, *[c.alias(name) for name, c in counts.items()])
        writer = observed.drop(SIDE).write
        (writer.partitionBy(*layout) if layout else writer).parquet(self._folder(run))
        return {name: seen.get[name] or 0 for name in counts}

    def _part(self, version: Version, run: str, rows: int) -> Part:
        """The part a load wrote, with the filter of its keys."""
        files = storage.count_files(self.spark, self._folder(run), ".parquet")
        if not version.keys:
            return Part(run, files)
        keys = self._rows(replace(version, parts=[Part(run, files)])).where(has_key(version.keys))
        words = word_count(rows)
        key_filter(keys, version.keys, words).write.parquet(self._filter(run))
        return Part(run, files, words)

    def _held(self, keys: DataFrame, version: Version) -> DataFrame:
        """The live target rows (key columns, load and file) of ``keys``, which have the
        columns of their folders. Only folders that these name are listed, and only keys that the
        filter of a live load does not deny are joined."""
        layout = self._layout(version)
        sizes = sorted({p.words for p in version.parts if p.words})
        own = [ref(k) for k in version.keys]
        named = keys.select(layout).distinct().collect() if sizes else []  # a row per folder
        if not named:
            return self._rows(replace(version, parts=[])).select(*own, RUN, F.lit("").alias("file"))
        may_be = [
            possible_keys(
                keys,
                version.keys,
                self.spark.read.parquet(
                    *[self._filter(p.run) for p in version.parts if p.words == words]
                ),
                words,
            )
            for words in sizes
        ]
        wanted = reduce(DataFrame.unionAll, may_be).toDF(*[f"_may_{k}" for k in range(len(own))])
        current = self._rows(version).where(has_key(version.keys))
        for place in layout:
            current = current.where(F.col(place).isin(sorted({r[place] for r in named})))
        same = [F.col(k) == F.col(f"_may_{i}") for i, k in enumerate(own)]
        return current.select(*own, RUN, self._file_of(version).alias("file")).join(
            wanted, same, "left_semi"
        )

    def _load(self, load: Callable[[Version, str], _Loaded], at_least: int) -> LoadReport:
        """Run one load; whatever happens before the publish leaves the target as it was."""
        run = "r" + uuid.uuid4().hex
        made = [self._folder(run), self._filter(run)]
        try:
            done = load(self.version(), run)
            if done.received < at_least:
                raise VerifyFailed(f"{at_least} rows to read, but {done.received} arrived")
        except BaseException:
            for folder in made:
                storage.remove(self.spark, folder)
            raise
        finally:
            storage.remove(self.spark, os.path.join(self.root, "staging", run))
        try:
            self._publish(done.version)
        except CommitConflict:
            for folder in made:
                storage.remove(self.spark, folder)
            raise
        updated = done.received - done.inserted
        return LoadReport(done.received, done.inserted, updated, done.version.number, done.rewritten)

    def append(
        self, df: DataFrame, markers: dict[str, str] | None = None, at_least: int = 0
    ) -> LoadReport:
        """All rows or none; fewer than ``at_least`` is a failure, and so is a key that is
        there already, in these rows or in the target (rows without a full key may
        repeat). Without keys, running it again appends again: only the caller's markers
        tell whether rows were loaded."""

        def load(old: Version, run: str) -> _Loaded:
            rows = align(df, self._schema(old), fill_missing=True)
            with sized_shuffles(self.spark, rows):
                received = self._write(rows, old, run)["rows"]
            if not received:
                storage.remove(self.spark, self._folder(run))
                return _Loaded(self._next(old, markers))
            part = self._part(old, run, received)
            if old.keys:
                written = self._rows(replace(old, parts=[part])).where(has_key(old.keys))
                require_unique_keys(written, old.keys)
                self._refuse(self._held(written, old), old)
            return _Loaded(self._next(old, markers, received, [*old.parts, part]), received, received)

        return self._load(load, at_least)

    def _refuse(self, held: DataFrame, version: Version) -> None:
        samples = held.drop(RUN, "file").limit(3).collect()
        if samples:
            shown = "; ".join(str(row.asDict()) for row in samples)
            raise KeyProblem(f"keys of the appended rows are in the target, for example {shown}")

    def upsert(
        self,
        df: DataFrame,
        keys: Sequence[str] = (),
        markers: dict[str, str] | None = None,
        at_least: int = 0,
        order: str | None = None,
    ) -> LoadReport:
        """Stage the rows, check them, merge them by key into the files that hold one, publish.

        With ``order``, a column, a row that comes before the one the target holds for its
        key changes nothing there.
        """

        def load(old: Version, run: str) -> _Loaded:
            schema = self._schema(old)
            if not old.keys:
                raise KeyProblem(f"the target at {self.root} was created without keys")
            if keys and set(merge_keys(schema.names, list(keys))) != set(old.keys):
                raise KeyProblem(f"the target is keyed by {old.keys}, not {list(keys)}")
            incoming = align(df, schema)
            merge_keys(incoming.columns, old.keys)

            staging, seen = os.path.join(self.root, "staging", run), Observation()
            incoming.observe(seen, F.count("*").alias("rows")).write.parquet(staging)
            received = seen.get["rows"] or 0
            if not received:
                return _Loaded(self._next(old, markers))
            staged = self.spark.read.schema(incoming.schema).parquet(staging)
            with sized_shuffles(self.spark, staged):
                require_unique_keys(staged, old.keys)
                full = align(staged.where(has_key(old.keys)), schema, fill_missing=True)
                held = self._held(self._placed(full, old), old)
                hit: dict[str, list[str]] = {}
                for row in held.select(RUN, "file").distinct().collect():
                    hit.setdefault(row[RUN], []).append(row["file"])
            files = sorted(name for names in hit.values() for name in names)
            current = self._rows(replace(old, parts=[p for p in old.parts if p.run in hit]))
            if files:
                current = current.where(self._file_of(old).isin(files))
            held_rows = current.select([ref(c) for c in schema.names])
            merged = merge_rows(held_rows, staged, old.keys, order)
            with sized_shuffles(self.spark, current, staged):
                wrote = self._write(
                    merged,
                    old,
                    run,
                    updated=F.count_if(F.col(SIDE) == UPDATED),
                    inserted=F.count_if(F.col(SIDE) == INSERTED),
                )
            inserted = wrote["inserted"]
            if wrote["updated"] + inserted != received:
                raise VerifyFailed(f"{received} rows staged, but {wrote} written")
            part = self._part(old, run, wrote["rows"])
            parts = [*self._without(old, hit), part]
            return _Loaded(self._next(old, markers, inserted, parts), received, inserted, len(files))

        return self._load(load, at_least)

    @staticmethod
    def _without(version: Version, files: dict[str, list[str]]) -> list[Part]:
        """The parts once ``files`` are rewritten; a part with no file left is forgotten."""
        left = [replace(p, gone=sorted({*p.gone, *files.get(p.run, [])})) for p in version.parts]
        return [p for p in left if len(p.gone) < p.files]

    def pack(self) -> LoadReport:
        """Rewrite all live rows as one load with files of even size; for the caller to run
        when many small loads have come in. Readers of earlier versions are not disturbed."""

        def load(old: Version, run: str) -> _Loaded:
            if not old.parts:
                return _Loaded(self._next(old, None))
            rows = self._rows(old).select([ref(c) for c in self._schema(old).names])
            with sized_shuffles(self.spark, rows):
                written = self._write(rows, old, run)["rows"]
            if written != old.rows:
                raise VerifyFailed(f"{old.rows} rows to pack, but {written} written")
            return _Loaded(self._next(old, None, 0, [self._part(old, run, written)]))

        return self._load(load, 0)

    def _next(
        self,
        old: Version,
        markers: dict[str, str] | None,
        more: int = 0,
        parts: list[Part] | None = None,
    ) -> Version:
        return replace(
            old,
            number=old.number + 1,
            rows=old.rows + more,
            parts=old.parts if parts is None else parts,
            markers={**old.markers, **(markers or {})},
        )

    def expire(self, keep: int = 2) -> list[str]:
        """Forget all but the newest ``keep`` versions, and the loads only they did not use.

        Loads that were never published are left alone: they may be running.
        """
        folder = os.path.join(self.root, "versions")
        numbers = sorted(
            int(n[:-5]) for n in storage.list_names(self.spark, folder) if n[0] != "."
        )
        old, new = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
        used = {p.run for number in new for p in self.version(number).parts}
        gone = sorted({p.run for number in old for p in self.version(number).parts} - used)
        for run in gone:
            storage.remove(self.spark, self._folder(run))
            storage.remove(self.spark, self._filter(run))
            storage.remove(self.spark, self.beside("digests", f"{RUN}={run}"))
        for number in old:
            storage.remove(self.spark, self._file(number))
        return gone
