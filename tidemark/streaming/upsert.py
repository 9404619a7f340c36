"""Continuous upsert: every micro-batch is one staged merge.

The number of the last merged batch is published in the same step as its rows,
so a batch that is replayed after a crash is recognised and skipped.

Sources deliver at least once. Equal rows of a batch are one row; a row that is
delivered again in a later batch merges to the same, unless it has no key. A column
that names the delivery removes those too: the ids of late are kept in the state store.
A column that orders the rows of a key makes the latest win, in a batch and across them.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import storage
from tidemark.functions.names import ref, resolve, resolve_all
from tidemark.operators.merge import has_key
from tidemark.sinks.files import FileTarget

_LONE, _HASH, _ROW, _ARRIVED = "tm_lone", "tm_hash", "tm_row", "tm_arrived"


def delivered(batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """A batch as it is merged: one row per key, and all rows without a full key.

    Those match nothing and are all inserted, equal ones as well; each gets a number, so
    they are spread by the one shuffle there is, whose rows are combined before it. Equal
    rows of a key are told by their hash. Of rows that differ, the last by ``order`` stays (of
    equal orders the one of greatest hash); without ``order`` they are left for the merge to refuse.
    """
    keys = resolve_all(batch.columns, keys)
    lone = F.when(~has_key(keys), F.monotonically_increasing_id())
    marked = [part for c in batch.columns for part in (F.col(ref(c)), F.col(ref(c)).isNull())]
    rows = batch.withColumn(_LONE, lone).withColumn(_HASH, F.xxhash64(*marked))
    own = [ref(k) for k in keys]
    if order is None:
        return rows.dropDuplicates([*keys, _LONE, _HASH]).select([ref(c) for c in batch.columns])
    place = F.struct(F.col(ref(resolve(batch.columns, order))), F.col(_HASH))
    row = F.struct(*[F.col(ref(c)) for c in batch.columns])
    last = rows.groupBy(*own, _LONE).agg(F.max_by(row, place).alias(_ROW))
    return last.select(*[F.col(_ROW).getField(c).alias(c) for c in batch.columns])


def delivered_once(stream: DataFrame, delivery: str, keep: str) -> DataFrame:
    """A stream without what was delivered before, as told by its delivery id.

    Ids are kept in the state store for ``keep`` after they arrived. Time is that of arrival,
    so no row is ever too late to be read. Rows without an id are all new.
    """
    name = resolve(stream.columns, delivery)
    arrived = stream.withColumn(_ARRIVED, F.current_timestamp()).withWatermark(_ARRIVED, keep)
    first = arrived.where(F.col(ref(name)).isNotNull()).dropDuplicatesWithinWatermark([name])
    unnamed = arrived.where(F.col(ref(name)).isNull())
    return first.unionByName(unnamed).drop(_ARRIVED)


def merge_batch(target: FileTarget, stream_id: Callable[[], str], order: str | None = None):
    """The ``foreachBatch`` function of one stream."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        # The batch runs in its own session; read and write the target there.
        own = FileTarget(batch.sparkSession, target.root)
        name = stream_id()
        version = own.version()
        done = version.markers.get(name)
        if done is None or int(done) < batch_id:
            rows = delivered(batch, version.keys, order)
            own.upsert(rows, markers={name: str(batch_id)}, order=order)

    return merge


def stream_upsert(
    stream: DataFrame,
    target: FileTarget,
    name: str,
    checkpoint: str,
    order: str | None = None,
    delivery: str | None = None,
    keep: str = "7 days",
) -> StreamingQuery:
    """Merge everything available now, batch by batch; run it again for what comes later.

    ``order`` and ``delivery`` are columns, see above; ``delivery`` may be one the target
    does not have. Batch numbers start over with a new checkpoint, so they are remembered
    under the id Spark keeps in the checkpoint.
    """

    def stream_id() -> str:
        metadata = storage.read_text(target.spark, os.path.join(checkpoint, "metadata"))
        return f"{name}/{json.loads(metadata)['id']}"

    if delivery is not None:
        stream = delivered_once(stream, delivery, keep)
        if resolve(stream.columns, delivery) not in target.schema().names:
            stream = stream.drop(resolve(stream.columns, delivery))
    return (
        stream.writeStream.foreachBatch(merge_batch(target, stream_id, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
