"""Ranked lexical search of every document for stated items, by bags that are scored once.

Terms are the runs of ASCII letters and digits and of all characters from U+0080 on, with
only A-Z lower-cased. Documents are restricted to the items' vocabulary: a document becomes
its number of terms n and the vector of (term, tf) in that vocabulary. With N documents
that have a term and L terms in all, m = 10 + (90 n N) div L; two documents with the same
vector and the same m have the same score for every item, so they are one class. Classes
are grouped by hash and by the vector itself, which verifies the hash. Each class is scored
once: the sum over an item's terms of w * ((10^9 tf) div (1000 tf + 8 m)), where
w = floor(1000 ln((2 N + 2) / (2 df + 1))). Of the classes of an item only ten can hold one
of its ten best documents (those first by score, then by lowest doc_id); their members
come back by ascending doc_id, ten a class.

Items are a stated query set, taken in blocks of at most ``BLOCK_TERMS`` terms (and one
item); a block's vocabulary is what is sent to the tasks. Its documents are read once a
block. Items without a term, and empty tables, have no rows. Items equal in id and text
are one item; items that share only the id are ranked apart. Null texts have no terms.
Documents without id come after those with one; repeated rows take a rank each.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import running, text_key, written

BLOCK_TERMS = 200_000
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")
_PIECE = 1 << 20
_SCORES_AT_ONCE = 1 << 21


def terms(text: Column) -> Column:
    """The terms of a text, in order; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def term_counts(text: bytes) -> Counter[bytes]:
    """How often each term occurs; a long text is counted by pieces that end between terms."""
    counts: Counter[bytes] = Counter()
    begin = 0
    while begin < len(text):
        gap = _BETWEEN.search(text, begin + _PIECE)
        end = gap.start() if gap else len(text)
        counts.update(_TERM.findall(text, begin, end))
        begin = end
    return counts


def _item_blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """item_id, key and distinct terms of every item, with the number of its block."""
    rows = items.select("item_id", text_key(F.col("text")).alias("key"), terms(F.col("text")).alias("t"))
    rows = (
        rows.select("item_id", "key", F.array_distinct("t").alias("terms"))
        .dropDuplicates(["item_id", "key"])
        .select("*", F.lit(0).alias("all"), F.size("terms").cast("long").alias("size"))
        .where("size > 0")
    )
    rows = written(rows, "items")
    count = rows.count()
    counted = running(rows, "all", "size", ["key", "item_id"], "before", -(-count // 5000) or 1)
    blocks = written(
        counted.select("item_id", "key", "terms", F.expr(f"before div {BLOCK_TERMS}").alias("block")),
        "item-blocks",
    )
    return blocks, (blocks.agg(F.max("block")).first()[0] or 0) + 1 if count else 0


def bags(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, the number of terms ``n`` and ``vector``: ids of known terms, then how often each occurs."""
    spark = documents.sparkSession
    known = spark.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = known.value
        for batch in batches:
            sizes, vectors = [], []
            for text in batch.column(1).cast(pa.binary()):
                counts = term_counts((text.as_py() or b"").lower())
                sizes.append(counts.total())
                pairs = sorted((ids[t], counts[t]) for t in counts.keys() & ids.keys())
                vectors.append(np.array(pairs, dtype=np.uint32).T.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary())],
                names=["doc_id", "n", "vector"],
            )

    id_type = documents.schema["doc_id"].dataType.simpleString()
    out = written(
        documents.select("doc_id", "text").mapInArrow(
            counted, f"doc_id {id_type}, n bigint, vector binary"
        ),
        "bags",
    )
    known.unpersist()
    return out


def _flat(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all vectors in a row: the vector's place, the term, how often."""
    parts = [np.frombuffer(v.as_py(), dtype=np.uint32).reshape(2, -1) for v in vectors]
    places = np.repeat(np.arange(len(parts)), [p.shape[1] for p in parts])
    both = np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((2, 0), np.int64)
    return places, both[0], both[1]


def document_frequencies(classes: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the ``size`` terms of the vocabulary."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            places, term, _ = _flat(batch.column(0))
            np.add.at(total, term, batch.column(1).to_numpy()[places])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    parts = classes.select("vector", "copies").mapInArrow(summed, "term bigint, df bigint")
    out = np.zeros(size, dtype=np.int64)
    for term, df in parts.groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class _Best:
    """The ``k`` best rows of each item met so far: by score, then by order."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, dtype=np.int64)  # a score must be above 0
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, scores: np.ndarray, order: np.ndarray, rows: np.ndarray) -> None:
        place, item = np.nonzero(scores >= self.least)
        if len(place):
            self.waiting.append((item, scores[place, item], order[place], rows[place]))
            self.held += len(place)
            if self.held > 4 * self.k * len(self.least) + 100_000:
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        if not self.waiting:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        item, score, order, row = (np.concatenate(c) for c in zip(*self.waiting))
        best = np.lexsort((order, -score, item))
        item, score, order, row = item[best], score[best], order[best], row[best]
        first = np.searchsorted(item, item)
        nth = np.arange(len(item)) - first
        last = nth == self.k - 1
        self.least[item[last]] = score[last]
        kept = nth < self.k
        out = tuple(c[kept] for c in (item, score, order, row))
        self.waiting, self.held = [out], len(out[0])
        return out


def best_classes(
    classes: DataFrame, weights: np.ndarray, item_terms: list[list[int]], k: int
) -> DataFrame:
    """item (its number), score, first_id and the class, the ``k`` best of each item."""
    by_term: list[list[int]] = [[] for _ in weights]
    for item, held in enumerate(item_terms):
        for term in held:
            by_term[term].append(item)
    begins = np.cumsum([0, *map(len, by_term)])
    postings = np.array([i for held in by_term for i in held], dtype=np.int64)
    items = len(item_terms)
    shared = classes.sparkSession.sparkContext.broadcast((weights, begins, postings))
    step = max(1, _SCORES_AT_ONCE // max(items, 1))

    def score(part: pa.RecordBatch) -> np.ndarray:
        weights, begins, postings = shared.value
        place, term, tf = _flat(part.column("vector"))
        m = part.column("m").to_numpy()[place]
        given = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        often = begins[term + 1] - begins[term]
        # Where each (class, term) goes on to: its items, one after the other.
        inner = np.arange(often.sum()) - np.repeat(np.cumsum(often) - often, often)
        item = postings[np.repeat(begins[term], often) + inner]
        cell = np.repeat(place, often) * items + item
        value = np.repeat(given, often)
        # Sums of doubles, in two parts that stay exact whatever the number of terms.
        low = np.bincount(cell, value & 0xFFFFFF, minlength=part.num_rows * items)
        high = np.bincount(cell, value >> 24, minlength=part.num_rows * items)
        total = (high.astype(np.int64) << 24) + low.astype(np.int64)
        return total.reshape(part.num_rows, items)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kept = _Best(items, k), None
        for batch in batches:
            # Rows of the best so far and of this batch, numbered together.
            given = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            offset = 0 if kept is None else kept.num_rows
            order = batch.column("first_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                rows = np.arange(begin, begin + part.num_rows)
                best.add(score(part), order[rows], offset + rows)
            item, points, at, row = best.settle()
            used, row = np.unique(row, return_inverse=True)
            kept = given.take(pa.array(used))
            best.waiting = [(item, points, at, row)]
        if kept is not None and best.held:
            item, points, _, row = best.settle()
            chosen = kept.take(pa.array(row)).combine_chunks()
            out = pa.table({"item": pa.array(item), "score": pa.array(points)})
            for name in ("first_id", "h", "m", "vector"):
                out = out.append_column(name, chosen.column(name))
            yield from out.to_batches()

    found = classes.select("first_id", "h", "m", "vector").mapInArrow(
        scored, "item bigint, score bigint, first_id bigint, h bigint, m bigint, vector binary"
    )
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first_id"))
    ranked = found.withColumn("nth", F.row_number().over(by_score)).where(F.col("nth") <= k)
    out = written(ranked.drop("nth", "first_id"), "best-classes")
    shared.unpersist()
    return out


def _block_search(documents: DataFrame, items: list, id_type, k: int) -> DataFrame:
    spark = documents.sparkSession
    vocabulary = sorted({t for row in items for t in row["terms"]})
    ids = {t: i for i, t in enumerate(vocabulary)}
    given = bags(documents, {t.encode(): i for t, i in ids.items()})
    n_docs, all_terms = given.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(all_terms or 0, 1)}L")
    keyed = (
        given.where(F.length("vector") > 0)
        .select("doc_id", m.alias("m"), "vector")
        .withColumn("h", F.xxhash64("m", "vector"))
    )
    classes = written(
        keyed.groupBy("h", "m", "vector").agg(
            F.count("*").alias("copies"), F.min("doc_id").cast("long").alias("first_id")
        ),
        "classes",
    )
    df = document_frequencies(classes, len(vocabulary)).tolist()
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1))) for held in df]
    best = best_classes(
        classes, np.array(weights, dtype=np.int64), [[ids[t] for t in row["terms"]] for row in items], k
    )
    # Members of the classes found: (h, m) of at most k classes an item finds the rows; the
    # vectors, compared whole, tell classes apart that only share them.
    wanted = F.broadcast(best.select("h", "m").distinct())
    same = Window.partitionBy("h", "m", "vector").orderBy(F.asc_nulls_last("doc_id"))
    members = written(
        keyed.join(wanted, ["h", "m"], "left_semi")
        .withColumn("nth", F.row_number().over(same))
        .where(F.col("nth") <= k)
        .drop("nth"),
        "members",
    )
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = (
        best.join(members, ["h", "m", "vector"])
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
    )
    names = spark.createDataFrame(
        [(i, row["item_id"]) for i, row in enumerate(items)], f"item bigint, item_id {id_type}"
    )
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score")


def ranked_search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` best documents above 0."""
    spark = documents.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    blocks, count = _item_blocks(items)
    found = [
        _block_search(
            documents,
            blocks.where(F.col("block") == number).orderBy("item_id", "key").collect(),
            id_type,
            k,
        )
        for number in range(count)
    ]
    if not found:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id {doc_type}, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def search_digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search(documents, benchmark)


SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents),
totals AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
counts AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM docs) GROUP BY rid, term),
wanted AS (
  SELECT DISTINCT item_id, text,
         unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
sized AS (
  SELECT rid, doc_id, (10 + (90 * len(terms) * n_docs) // n_terms)::BIGINT AS m
  FROM docs, totals WHERE len(terms) > 0),
scored AS (
  SELECT item_id, text, rid, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sized USING (rid)
  GROUP BY item_id, text, rid, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
