"""SimHash near-dedup: fingerprints that differ in few bits, found by their bit counts.

A fingerprint is embedded as the bit counts of its 32 segments of two bits. Flipping one
bit moves one count by one, so the Manhattan distance of two embeddings never exceeds
their Hamming distance. Two fingerprints within four bits are therefore within two, in
Manhattan distance, in one half of the embedding (16 segments); and then some cell of that
half's integer grid is within one of both. So each distinct fingerprint is entered, for
each half, in its own cell and the cells one step away (50 cells on average), and those
that meet in a cell are checked exactly.

Within a cell links are emitted as a spanning forest, not as all pairs, so a cell of many
near copies costs a row a member. Cells with more than ``CELL_LIMIT`` members are cut into
blocks, and every two blocks are compared by a task of their own. Components grow by
alternating large-star and small-star steps on tables in the shared folder.

Null and empty texts have fingerprint zero, which links like any other. Equal rows share a
component. The id of a component is its smallest non-null doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_key, written

SHINGLE = 4
MOST_BITS = 4
SEED = 42
CELL_LIMIT = 20_000
SHORT_RUN = 32
_BATCH = 1 << 17  # shingle hashes unpacked to bits at a time


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 of every shingle of the words, repeats included."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    if len(words) <= width:
        return [digest(joined, SEED)]
    starts = [0] + [e + 1 for e in ends[:-width]]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :], strict=True)]


def majority_bits(hashes: list[int]) -> int:
    """The 64 bits set in more than half of the hashes, as a signed number."""
    set_ = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BATCH):
        part = np.array(hashes[at : at + _BATCH], "<u8").view(np.uint8).reshape(-1, 8)
        set_ += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([majority_bits(shingle_hashes(t, width)) for t in texts], dtype="int64")

    return of(text)


def _cells(fp: Column) -> Column:
    """The cells a fingerprint is entered in, as numbers: half, then 16 counts of two bits."""
    cells = []
    for half in range(2):
        bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        odd = F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(0x55555555))
        own = bits - odd + F.lit(half << 32)  # counts of each two bits, side by side
        cells.append(own)
        for k in range(0, 32, 2):
            count = F.shiftrightunsigned(own, k).bitwiseAND(F.lit(3))
            cells.append(F.when(count < 2, own + F.lit(1 << k)))
            cells.append(F.when(count > 0, own - F.lit(1 << k)))
    return F.array_compact(F.array(*cells))


def _forest(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the members of one cell under the link rule."""
    edges, rest = [], np.unique(fps)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.bitwise_count(rest ^ node) <= most
            found = rest[near]
            edges += [(int(node), int(x)) for x in found]
            queue += list(found)
            rest = rest[~near]
    return edges


def _links(cells: np.ndarray, fps: np.ndarray, most: int) -> np.ndarray:
    """Links among rows sorted by cell: pairs of fingerprints, lower first."""
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    lengths = np.diff(np.r_[starts, len(cells)])
    length_of = np.repeat(lengths, lengths)
    ones = np.bitwise_count(fps).astype(np.int8)
    pairs = []
    at = np.flatnonzero(length_of <= SHORT_RUN)
    for shift in range(1, SHORT_RUN):
        at = at[at + shift < len(cells)]
        at = at[cells[at + shift] == cells[at]]
        if not len(at):
            break
        # The coarsest bound first: bit counts of the whole differ by at most ``most``.
        near = at[np.abs(ones[at + shift] - ones[at]) <= most]
        near = near[np.bitwise_count(fps[near + shift] ^ fps[near]) <= most]
        pairs.append(np.stack([fps[near], fps[near + shift]], axis=1))
    for start, length in zip(starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN], strict=True):
        edges = _forest(fps[start : start + length], most)
        pairs.append(np.array(edges, np.uint64).reshape(-1, 2))
    found = np.concatenate(pairs) if pairs else np.empty((0, 2), np.uint64)
    found = found[found[:, 0] != found[:, 1]]
    return np.unique(np.sort(found.view(np.int64), axis=1), axis=0)


def _link_runs(most: int):
    """Rows (cell, fp), sorted by cell, to links; a cell may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def links(cells, fps):
            found = _links(cells, fps.view(np.uint64), most)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(cells, cells[-1]))
            if last or (held and held[0][0][0] != cells[0]):
                # All but the last cell of this batch are whole.
                held.append((cells[:last], fps[:last]))
                yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append((cells[last:], fps[last:]))
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def links(fingerprints: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """a, b: enough links between distinct fingerprints (column fp) to connect all that link."""
    if most > 4:
        raise ValueError("the cells cover up to four differing bits")
    entered = fingerprints.select(F.explode(_cells(F.col("fp"))).alias("cell"), "fp")
    hot = written(
        entered.groupBy("cell")
        .count()
        .where(F.col("count") > CELL_LIMIT)
        .select("cell", F.ceil(F.col("count") / CELL_LIMIT).cast("int").alias("blocks")),
        "hot-cells",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    in_blocks = (
        entered.join(hot, "cell")
        .select("cell", "fp", own.alias("own"), other.alias("other"))
        .select(
            F.xxhash64(
                "cell", F.least("own", "other"), F.greatest("own", "other")
            ).alias("cell"),
            "fp",
        )
    )
    meeting = entered.join(hot, "cell", "left_anti").unionByName(in_blocks)
    found = (
        meeting.repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_link_runs(most), "a long, b long")
    )
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node connected with each node that has an edge (a, b)."""
    edges = written(edges, "edges")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "large-star")  # u above v
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(
            small.union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
            .select(F.col("v").alias("a"), F.col("u").alias("b")),
            "small-star",
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def near_groups(docs: DataFrame, width: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """doc_id, text_key, fp of every row, and ``first``: the first row of its component.

    ``first`` is a struct (no_id, doc_id, text_key); rows are ordered by id, nulls last.
    """
    prints = written(
        docs.select(
            "doc_id", text_key(F.col("text")).alias("text_key"),
            fingerprint(F.col("text"), width).alias("fp"),
        ),
        "fingerprints",
    )
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = written(prints.groupBy("fp").agg(F.min(place).alias("first")), "classes")
    roots = components(links(classes.select("fp"), most))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    members = written(rooted.drop("first").join(firsts, "root").select("fp", "first"), "members")
    return prints.join(members, "fp")


def simhash_digest(documents: DataFrame) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_groups(documents.select("doc_id", "text")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each component, the first, all columns as given."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = (
        near_groups(documents.select("doc_id", "text"))
        .where(place == F.col("first"))
        .select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        .distinct()
    )
    given = documents.select(
        F.struct("*").alias("__row"), "doc_id", text_key(F.col("text")).alias("__text")
    )
    alike = given.join(
        kept, given["doc_id"].eqNullSafe(kept["__id"]) & (given["__text"] == kept["__key"])
    )
    # Rows equal in id and text are one document: of its rows, the one of least hash.
    one = F.min_by("__row", F.xxhash64("__row")).alias("__row")
    return alike.groupBy("__id", "__key").agg(one).select("__row.*")
