"""Mixing sources to target weights: blocks of words, drawn shard by shard over the sources.

The words of a source are laid end to end (documents in the order of a hash) and packed
into blocks of ``block_words``. A source's target says how many blocks it gives; output shards
are of equal size, at most one block apart. How many blocks of each source a shard takes is a
multinomial draw over the sources, weighted by the blocks that each still has to give; what a
source lacks is drawn again from the others, so the totals of the sources are exact. With many
sources the draw is over ranges of them first, then over the sources of each range, so no task
sees more than some thousand rows. A source's draws are numbered through the shards; number j
takes block ``perm(j mod blocks)`` in epoch ``j div blocks``, where ``perm`` is a keyed
permutation of the source's blocks, so no block comes up twice before all have come up once.
Within a shard, sources are interleaved by one more permutation of its slots. Slots and the
pieces of documents then join by (source, block); ``packed_blocks`` delivers the blocks.

Targets: sources by code point, null last, weigh 1, 2, 3, repeating, and share all words;
none gets more than ``most_epochs`` times its size, the excess is reshared by weight.

Everything is seeded, so reruns agree. Null or empty texts have no words and are never
taken. Rows equal in id and text may change places, which the result does not show.
An empty table gives an empty mix. No source is gathered in one task: running totals are
cut into buckets by hash, and only single rows of sums reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bucket_count, running, text_key, words, written

_CHUNK = 100_000  # slots made of one row at a time
_TASK = 500_000  # slots made by one task, about
_RANGE = 1_000  # sources whose counts one task draws
#: Constants of a public 64-bit mixing function (splitmix64).
_ADD, _FIRST, _SECOND = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (1, 2, 3)
    most_epochs: int = 3
    block_words: int = 64
    shards: int = 64
    seed: int = 20240601


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(_ADD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_FIRST)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_SECOND)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where each index goes under the permutation of range(size) that ``key`` names.

    Four Feistel rounds over the next power of four; results outside are sent round again.
    """
    index, size, key = (np.asarray(x).astype(np.uint64) for x in (index, size, key))
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2 + 1e-9).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.copy(), np.flatnonzero(size > 1)
    while len(todo):
        b, m = bits[todo], mask[todo]
        left, right = out[todo] >> b, out[todo] & m
        for turn in range(4):
            salt = _mixed(key[todo] + np.uint64(turn))
            left, right = right, left ^ (_mixed(right ^ salt) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def with_sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__row`` (pinned by the write), ``__key`` and ``__size``."""
    return written(
        docs.select(
            "*",
            F.monotonically_increasing_id().alias("__row"),
            text_key(F.col("text")).alias("__key"),
            F.size(words(F.col("text"))).cast("long").alias("__size"),
        ),
        "sized",
    )


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row a source: id, size, weight, target, blocks, slots."""
    sums = written(
        sized.groupBy(F.col("source").alias("name")).agg(F.sum("__size").alias("source_size"))
        .repartitionByRange(F.col("name").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()),
        "sources",
    )
    # The rank of a source: its place in its range, after all ranges before.
    parts = sums.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(F.col("name").asc_nulls_last())
    ranked = sums.join(starts, "part").select(
        "name", "source_size", (F.col("start") + F.row_number().over(inside) - 1).alias("source_id")
    )
    weight = F.get(F.array(*map(F.lit, mix.weights)), (F.col("source_id") % len(mix.weights)).cast("int"))
    weighed = written(ranked.withColumn("weight", weight.cast("long")), "weights")
    level = _level(weighed, mix.most_epochs)
    most = (F.col("source_size") * mix.most_epochs).cast("double")
    target = F.least(most, F.col("weight") * F.lit(level))
    blocks = F.ceil(F.col("source_size") / mix.block_words)
    # Short last blocks are allowed for: slots of the source's own mean block.
    slots = F.when(blocks > 0, F.round(target * blocks / F.col("source_size"))).otherwise(0)
    return weighed.select("*", target.alias("target"), blocks.cast("long").alias("blocks")).withColumn(
        "slots", slots.cast("long")
    )


def _level(weighed: DataFrame, epochs: int) -> float:
    """Words a unit of weight gets, when no source gets more than ``epochs`` times its size."""
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, free = 0.0, None
    while True:
        capped = F.col("source_size") * epochs < F.col("weight") * F.lit(level)
        sums = weighed.agg(
            F.sum(F.when(capped, F.col("source_size") * epochs)).alias("full"),
            F.sum(F.when(~capped, F.col("weight"))).alias("free"),
        ).first()
        if sums["free"] is None or sums["free"] == free:
            return level
        free = sums["free"]
        level = (total - (sums["full"] or 0)) / free


def drawn(sizes: np.ndarray, have: np.ndarray, seed: list[int]) -> np.ndarray:
    """Counts by source and shard: ``have`` in all of a source, ``sizes`` in all of a shard."""
    dice, left = np.random.default_rng(seed), np.array(have, np.int64)
    counts = np.zeros((len(left), len(sizes)), np.int64)
    for shard, size in enumerate(np.asarray(sizes, np.int64)):
        while short := int(size - counts[:, shard].sum()):
            total = int(left.sum())
            got = left if short == total else np.minimum(dice.multinomial(short, left / total), left)
            counts[:, shard] += got
            left = left - got
    return counts


def shard_counts(sources: DataFrame, mix: Mix) -> DataFrame:
    """source_id, counts (blocks it gives to each shard) and places (the first slot of those)."""
    some = sources.where("slots > 0").select("source_id", "slots")
    part = F.expr(f"source_id DIV {_RANGE}").alias("part")
    ranges = some.groupBy(part).agg(F.sum("slots").alias("slots"))
    listed = "counts array<long>, places array<long>"

    def rows(ids: pd.Series, counts: np.ndarray, places: np.ndarray, name: str) -> pd.DataFrame:
        before = places + np.cumsum(counts, axis=0) - counts
        return pd.DataFrame({name: ids, "counts": list(counts), "places": list(before)})

    def of_ranges(given: pd.DataFrame) -> pd.DataFrame:
        given = given.sort_values("part")
        even = np.full(mix.shards, int(given["slots"].sum()) // mix.shards)
        even[: int(given["slots"].sum()) % mix.shards] += 1
        counts = drawn(even, given["slots"].to_numpy(), [mix.seed])
        return rows(given["part"], counts, np.zeros(mix.shards, np.int64), "part")

    def of_sources(given: pd.DataFrame) -> pd.DataFrame:
        given, first = given.sort_values("source_id"), given.iloc[0]
        counts = drawn(first["counts"], given["slots"].to_numpy(), [mix.seed, 1 + int(first["part"])])
        return rows(given["source_id"], counts, np.asarray(first["places"]), "source_id")

    # One row for a range of sources: a thousandth of the sources.
    by_range = ranges.groupBy().applyInPandas(of_ranges, f"part long, {listed}")
    given = some.withColumn("part", part).join(by_range, "part")
    return given.groupBy("part").applyInPandas(of_sources, f"source_id long, {listed}")


def slots(sources: DataFrame, mix: Mix) -> DataFrame:
    """source_id, shard, slot (from 0 in its shard), epoch, block of everything the mix takes."""

    @F.pandas_udf("long")
    def permuted_index(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy()))

    key = F.crc32(F.coalesce(F.col("name"), F.lit(""))) + F.col("name").isNull().cast("long")
    counts = shard_counts(sources, mix).withColumn(
        "shards", F.arrays_zip(F.sequence(F.lit(0), F.lit(mix.shards - 1)).alias("shard"), "counts", "places")
    )
    total = sources.agg(F.sum("slots")).first()[0] or 0
    size = F.lit(total // mix.shards) + (F.col("s.shard") < total % mix.shards).cast("long")
    cut = (
        sources.select("source_id", "blocks", key.alias("key"))
        .join(counts, "source_id")
        .select("source_id", "blocks", "key", "counts", F.explode("shards").alias("s"))
        .select(
            "source_id", "blocks", "key", F.col("s.shard").alias("shard"), F.col("s.counts").alias("count"),
            F.col("s.places").alias("place"),
            F.expr("aggregate(slice(counts, 1, s.shard), 0L, (a, n) -> a + n)").alias("first"),
            size.alias("shard_size"),
        )
    )
    # Large shards of large sources are cut, and dealt out before their slots are made: to a number
    # of tasks that is given, as the rows are so small here that they would all be put in one.
    chunks = (
        cut.where("count > 0")
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, count - 1, {_CHUNK}L)")))
        .repartition(max(1, -(-total // _TASK)), "source_id", "shard", "chunk")
    )
    each = chunks.withColumn(
        "i", F.explode(F.expr(f"sequence(chunk, least(chunk + {_CHUNK}L, count) - 1)"))
    ).withColumn("number", F.col("first") + F.col("i"))
    return each.select(
        "source_id", "shard",
        permuted_index(F.col("place") + F.col("i"), "shard_size", F.col("shard") + mix.seed).alias("slot"),
        F.expr("number DIV blocks").alias("epoch"),
        permuted_index(F.expr("number % blocks"), "blocks", F.col("key") + mix.seed).alias("block"),
    )


def mixed(sized: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The sources with their targets, and the pieces taken: __row, epoch, at (in its source), offset, words, shard, slot."""
    sources = written(targets(sized, mix), "targets")
    ids = sources.select(F.col("name").alias("__name"), "source_id")
    rows = sized.select("__row", "doc_id", "__key", "source", "__size").join(
        ids, sized["source"].eqNullSafe(ids["__name"])
    )
    count = sized.count()
    laid = running(rows, "source_id", "__size", ["doc_id", "__key"], "start", bucket_count(count))
    n, end = mix.block_words, F.col("start") + F.col("__size")
    pieces = laid.where("__size > 0").select(
        "__row", "source_id", "start", end.alias("end"),
        F.explode(F.expr(f"sequence(start DIV {n}, (start + __size - 1) DIV {n})")).alias("block"),
    )
    low = F.greatest(F.col("start"), F.col("block") * n)
    pieces = pieces.select(
        "__row", "source_id", "block", low.alias("at"), (low - F.col("start")).alias("offset"),
        (F.least(F.col("end"), (F.col("block") + 1) * n) - low).alias("words"),
    )
    # Slots are made of few rows, so Spark takes them for a small table; they grow with the text.
    return sources, pieces.join(slots(sources, mix).hint("merge"), ["source_id", "block"])


def mix_digest(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Size, target and taken words of every document."""
    sized = with_sizes(documents.select("doc_id", "text", "source")).drop("text")
    sources, taken = mixed(sized, mix)
    words_taken = taken.groupBy("__row").agg(F.sum("words").alias("taken"))
    return (
        sized.join(sources, sized["source"].eqNullSafe(sources["name"]))
        .join(words_taken, "__row", "left")
        .select(
            "doc_id", F.col("__size").alias("size"), "source_size", "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_texts(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: a row for each document and epoch, with the words taken in it.

    A document taken whole keeps its text as it is; else the pieces, joined by spaces.
    """
    sized = with_sizes(documents)
    _, taken = mixed(sized, mix)
    pieces = taken.groupBy("__row", "epoch").agg(
        F.sort_array(F.collect_list(F.struct("offset", "words"))).alias("__pieces"),
        F.sum("words").alias("__taken"),
    ).drop("epoch")  # a document may have a column of that name
    parts = F.transform(
        "__pieces",
        lambda p: F.slice("__words", (p["offset"] + 1).cast("int"), p["words"].cast("int")),
    )
    text = F.when(F.col("__taken") == F.col("__size"), F.col("text")).otherwise(
        F.array_join(F.flatten(parts), " ")
    )
    joined = sized.join(pieces, "__row").withColumn("__words", words(F.col("text")))
    whole = joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in documents.columns])
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        whole = whole.withColumn("n_chars", F.length("text").cast(kind))
    return whole


def packed_blocks(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as it is trained on: shard, slot, source, epoch, block, and its words in one text.

    Every shard has the slots 0 to its size, one block each; only a source's last block may have
    fewer than ``block_words`` words. Documents follow each other in a block without a mark.
    """
    sized = with_sizes(documents.select("doc_id", "text", "source"))
    _, taken = mixed(sized, mix)
    some = F.slice(words(F.col("text")), (F.col("offset") + 1).cast("int"), F.col("words").cast("int"))
    texts = sized.select("__row", "source", "text").join(taken, "__row").select(
        "shard", "slot", "source", "epoch", "block", F.struct("at", F.array_join(some, " ").alias("part")).alias("part")
    )
    blocks = texts.groupBy("shard", "slot").agg(
        *[F.first(c).alias(c) for c in ("source", "epoch", "block")],
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    return blocks.withColumn("text", F.array_join("parts.part", " ")).drop("parts")
